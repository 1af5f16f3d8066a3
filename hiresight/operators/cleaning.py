"""Cleaning stage: unknown markers, boolean coercion, imputation, dates,
currency-restricted measure with winsorising, keep-latest deduplication.

Data-dependent decisions (which columns are mostly NULL, which string columns
look boolean) take **one** bounded aggregate (a single output row) over the
table; everything else is a lazy projection.
"""
from __future__ import annotations

from dataclasses import dataclass, field
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import exprs as X
from .quantiles import global_quantiles, join_on_keys, localized


@dataclass
class Cleaned:
    """A cleaned DataFrame plus the report of what was touched."""
    df: DataFrame
    report: dict = field(default_factory=dict)


def _norm_markers(markers: Iterable[str] | None) -> list[str]:
    return sorted({m.strip().lower() for m in (markers if markers is not None else C.UNKNOWN_MARKERS)})


def is_marker(c: Column, markers: Iterable[str] | None = None) -> Column:
    return F.lower(F.trim(c)).isin(*_norm_markers(markers))


# ------------------------------------------------------------------- C1 --
def standardize_unknown_markers(df: DataFrame, markers: Iterable[str] | None = None,
                                columns: Sequence[str] | None = None, report: bool = False):
    """String values equal (trimmed, lower-case) to a marker → NULL.

    With ``report=True`` also returns the columns that contained a marker
    (one bounded aggregate)."""
    cols = [c for c in (columns or X.string_columns(df)) if c in X.string_columns(df)]
    out = df.withColumns({c: F.when(is_marker(F.col(c), markers), F.lit(None).cast("string")).otherwise(F.col(c))
                          for c in cols}) if cols else df
    if not report:
        return out
    if not cols:
        return out, []
    hits = df.agg(*[F.max(F.coalesce(is_marker(F.col(c), markers), F.lit(False)).cast("int")).alias(c)
                    for c in cols]).first()
    return out, [c for c in cols if hits[c]]


# ------------------------------------------------------------------- C2 --
def null_shares(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A29 building block: one-row wide frame of NULL shares per column."""
    cols = list(columns or df.columns)
    return df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])


def drop_mostly_missing(df: DataFrame, threshold: float = 0.95) -> tuple[DataFrame, list[str]]:
    """Drop columns whose NULL share is >= threshold (one bounded action)."""
    row = null_shares(df).first()
    to_drop = [c for c in df.columns if row[c] is not None and row[c] >= threshold]
    return (df.drop(*to_drop) if to_drop else df), to_drop


# --------------------------------------------------------------- C3–C6 --
def bool_like_expr(c: Column, null_markers: Iterable[str] | None = None, force: bool = True) -> Column:
    """true/1/yes → true, false/0/no → false, markers → NULL; other
    values → NULL (``force``) or the column is left as is by the caller."""
    s = F.lower(F.trim(c.cast("string")))
    e = (F.when(c.isNull(), F.lit(None).cast("boolean"))
          .when(s.isin(*C.BOOL_TRUE_TOKENS), F.lit(True))
          .when(s.isin(*C.BOOL_FALSE_TOKENS), F.lit(False))
          .when(s.isin(*_norm_markers(null_markers)), F.lit(None).cast("boolean")))
    return e.otherwise(F.lit(None).cast("boolean"))


def _is_bool_like_value(c: Column, null_markers: Iterable[str] | None = None) -> Column:
    s = F.lower(F.trim(c.cast("string")))
    return c.isNull() | s.isin(*(C.BOOL_TRUE_TOKENS + C.BOOL_FALSE_TOKENS + _norm_markers(null_markers)))


def detect_bool_like(df: DataFrame, columns: Sequence[str], null_markers: Iterable[str] | None = None) -> list[str]:
    """Columns whose every value is boolean-like (one bounded aggregate)."""
    if not columns:
        return []
    row = df.agg(*[F.bool_and(_is_bool_like_value(F.col(c), null_markers)).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] is None or row[c]]


def coerce_boolean_columns(df: DataFrame, force_columns: Sequence[str] | None = None, detect: bool = True,
                           null_markers: Iterable[str] | None = None,
                           prefixes: Sequence[str] = C.PREFIX_GROUPS) -> tuple[DataFrame, list[str]]:
    """Prefixed columns, ``salary_gross`` and listed columns are forced to
    boolean; other string/integer columns are converted only if every value is
    boolean-like (detected in one aggregate).  Numeric counters are never
    touched (fixes the all-NULL float quirk)."""
    forced = [c for c in df.columns
              if (c in set(force_columns or ()) or c == "salary_gross" or any(c.startswith(p) for p in prefixes))
              and not isinstance(df.schema[c].dataType, T.BooleanType)
              and isinstance(df.schema[c].dataType, (T.StringType, T.IntegralType, T.BooleanType))]
    candidates = [c for c in X.string_columns(df) if c not in forced] if detect else []
    detected = detect_bool_like(df, candidates, null_markers)
    conv = forced + detected
    out = df.withColumns({c: bool_like_expr(F.col(c), null_markers) for c in conv}) if conv else df
    return out, conv


def ensure_boolean(df: DataFrame, column: str = "salary_gross",
                   null_markers: Iterable[str] | None = None) -> DataFrame:
    """Force one column to nullable boolean; other columns untouched."""
    if column not in df.columns:
        return df
    return df.withColumn(column, bool_like_expr(F.col(column), null_markers))


# --------------------------------------------------------------- C7–C9 --
def fill_categorical(df: DataFrame, fill_map: Mapping[str, str] = C.CATEGORICAL_IMPUTE_MAP) -> DataFrame:
    """Fill NULLs of existing string columns in the map."""
    strings = set(X.string_columns(df))
    m = {c: v for c, v in fill_map.items() if c in strings}
    return df.fillna(m) if m else df


def fill_counters(df: DataFrame, fill_map: Mapping[str, float] = C.NUMERIC_IMPUTE_RULES) -> DataFrame:
    """Fill NULLs of numeric columns in the map or ending with ``_count``."""
    m = {}
    for c in X.numeric_columns(df):
        if c in fill_map:
            m[c] = fill_map[c]
        elif c.endswith("_count"):
            m[c] = 0
    return df.fillna(m) if m else df


def handle_missingness(df: DataFrame, drop_threshold: float | None = 0.95,
                       markers: Iterable[str] | None = None) -> Cleaned:
    """C1 → C2 → C3 → C7 → C8, with a report of touched columns."""
    df1, marked = standardize_unknown_markers(df, markers, report=True)
    dropped: list[str] = []
    if drop_threshold is not None:
        df1, dropped = drop_mostly_missing(df1, drop_threshold)
    df2, bools = coerce_boolean_columns(df1, null_markers=markers)
    df3 = fill_counters(fill_categorical(df2))
    return Cleaned(df3, {"normalized_unknown_cols": marked, "dropped_cols": dropped, "bool_like_cols": bools})


# ------------------------------------------------------------------ C10 --
def parse_dates(df: DataFrame, published_col: str = "published_at_iso", scraped_col: str = "scraped_at_utc",
                fmt: str | None = None) -> DataFrame:
    """Strings → UTC timestamps (invalid → NULL), age in floored whole days."""
    from .features import age_days
    new = {}
    for c in (published_col, scraped_col):
        if c in df.columns:
            dt = df.schema[c].dataType
            if isinstance(dt, T.StringType):
                new[c] = F.try_to_timestamp(F.col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(c))
            else:
                new[c] = F.col(c).cast("timestamp")
    out = df.withColumns(new) if new else df
    if published_col in out.columns and scraped_col in out.columns:
        out = out.withColumn("vacancy_age_days", age_days(F.col(published_col), F.col(scraped_col)))
    return out


# ------------------------------------------------------------------ C11 --
def salary_prepare(df: DataFrame, measure: str = "salary_mid", currency_col: str = "currency",
                   currency: str = "RUB", lower: float = 0.01, upper: float = 0.99,
                   out_prefix: str = "salary_mid_rub", quantile_method: str = "exact") -> DataFrame:
    """C11: measure kept only for one currency, known flag, 1 %/99 % clipping.

    The clip edges are exact global quantiles (distributed selection), computed once,
    now, and joined back as a broadcast one-row frame; an all-NULL measure stays unclipped."""
    if measure in df.columns and currency_col in df.columns:
        rub = F.when(F.col(currency_col) == currency, F.col(measure).cast("double"))
    elif measure in df.columns:
        rub = X.typed_null("double")
    else:
        rub = X.typed_null("double")
    t = df.withColumn(out_prefix, rub).withColumn("salary_known", F.col(out_prefix).isNotNull())
    edges = localized(global_quantiles(t, out_prefix, [lower, upper], ["_lo", "_hi"], quantile_method))
    t = join_on_keys(t, edges, [])
    v = F.col(out_prefix)
    capped = F.when(v.isNull(), v).when(F.col("_lo").isNull(), v).otherwise(F.least(F.greatest(v, F.col("_lo")), F.col("_hi")))
    return t.withColumn(f"{out_prefix}_capped", capped).drop("_lo", "_hi")


def non_currency_share(df: DataFrame, currency_col: str = "currency", currency: str = "RUB") -> Column:
    """A39 aggregate expression: share of rows whose currency is not the target."""
    if currency_col not in df.columns:
        return F.lit(0.0)
    return F.avg((F.coalesce(F.col(currency_col), F.lit("")) != currency).cast("double"))


# ------------------------------------------------------------------- W1 --
def deduplicate(df: DataFrame, id_col: str = "vacancy_id", order_col: str | None = "scraped_at_utc",
                tiebreak: Sequence[str] = ()) -> DataFrame:
    """Keep the latest row per id (NULL timestamps lose; all-NULL ids form one group).

    First only the id, the ordering columns and a 128-bit hash of the row are reduced (a
    grouped ``max`` with partial aggregation: a hot id is one narrow row per task).  Then
    the winning rows are fetched whole by one semi-join, so whole rows are shuffled at most
    once and never sorted by an aggregate.  Rows that tie in all ordering columns go by
    the hash; equal rows count once."""
    if id_col not in df.columns:
        return df
    if len(df.columns) == 1:
        return df.dropDuplicates([id_col])
    order = [c for c in ([order_col] if order_col and order_col in df.columns else []) + list(tiebreak)]
    whole = [F.col(f"`{c}`") for c in df.columns]
    marked = df.withColumns({"_h1": F.xxhash64(*whole), "_h2": F.xxhash64(F.lit(1), *whole)})
    lead = F.struct(*[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)], "_h1", "_h2")
    best = marked.groupBy(F.col(f"`{id_col}`").alias("_id")).agg(F.max(lead).alias("_best")) \
        .select("_id", F.col("_best._h1").alias("_b1"), F.col("_best._h2").alias("_b2"))
    same = marked[f"`{id_col}`"].eqNullSafe(best["_id"]) & (marked["_h1"] == best["_b1"]) & (marked["_h2"] == best["_b2"])
    return marked.join(best, same, "left_semi").distinct().drop("_h1", "_h2")
