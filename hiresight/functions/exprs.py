"""Column-expression builders shared by the operators.

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` so that
the work stays inside whole-stage codegen; nothing here runs Python per row.
"""
from __future__ import annotations

from functools import reduce
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def flag_int(c, null_as_false: bool = True) -> Column:
    """Boolean flag as 0/1 int; NULL → 0 when ``null_as_false`` else NULL."""
    x = col(c).cast("boolean")
    if null_as_false:
        x = F.coalesce(x, F.lit(False))
    return x.cast("int")


def flag_share(c, null_as_false: bool = True) -> Column:
    """Mean of a flag.  ``null_as_false`` = pandas ``fillna(False).mean()``;
    otherwise NULLs are skipped like pandas ``mean()`` of a nullable column."""
    return F.avg(flag_int(c, null_as_false).cast("double"))


def any_true(cols: Sequence) -> Column:
    """OR of flags with NULL treated as False; false for an empty list."""
    if not cols:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [F.coalesce(col(c).cast("boolean"), F.lit(False)) for c in cols])


def count_true(cols: Sequence) -> Column:
    """Number of true flags per row (NULL counts as 0); int.  Null-safe equality is the
    shortest code for a flag: sums of many longer ones grow past what the JVM compiles."""
    if not cols:
        return F.lit(0)
    return reduce(lambda a, b: a + b, [col(c).cast("boolean").eqNullSafe(F.lit(True)).cast("int") for c in cols])


def evaluated_once(value: Column, rule: Callable[[Column], Column]) -> Column:
    """``rule(value)`` for a rule that names its argument many times: Spark would put a
    long ``value`` (a count of flags) in every place."""
    return F.transform(F.array(value), rule)[0]


def safe_div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL (pandas NaN)."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def order_rank(c, order: Sequence[str], big: int = 10_000) -> Column:
    """Rank of a category in an explicit order; unlisted values last."""
    if not order:
        return F.lit(big)
    m = F.create_map(*[x for i, v in enumerate(order) for x in (F.lit(v), F.lit(i))])
    return F.coalesce(m[col(c)], F.lit(big))


def map_lookup(c, mapping: dict, default=None) -> Column:
    """``mapping.get(c, default)`` as a map literal lookup (missing key → NULL)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    out = m[col(c)]
    return F.coalesce(out, F.lit(default)) if default is not None else out


def contains_any(text: Column, tokens: Iterable[str]) -> Column:
    """Literal substring test of any token; ``text`` should already be lower-case."""
    toks = list(tokens)
    if not toks:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [text.contains(t) for t in toks])


def typed_null(dtype: str | T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def bool_columns(df: DataFrame, prefix: str | None = None) -> list[str]:
    """Names of BooleanType columns (optionally restricted to a prefix)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.BooleanType) and (prefix is None or f.name.startswith(prefix))]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def require_columns(df: DataFrame, cols: Iterable[str], where: str) -> None:
    """ValueError naming the operator and the absent columns."""
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"{where} needs {', '.join(absent)}; the table has no such column")


def require_prefix(df: DataFrame, prefix: str, where: str) -> None:
    if not any(c.startswith(prefix) for c in df.columns):
        raise ValueError(f"{where} needs at least one {prefix} column")


def rounded(c, digits: int = 6) -> Column:
    return F.round(col(c).cast("double"), digits)


def unpivot_one_row(df: DataFrame, names: Sequence[str], name_col: str, value_col: str,
                    ids: Sequence[str] = ()) -> DataFrame:
    """Long form of a wide aggregate (``stack`` of the named columns)."""
    return df.unpivot(list(ids), list(names), name_col, value_col)
