"""Data-quality reports: missing shares, data health, key checks, describe,
stage summaries and the clean-table validation.  Each report is one wide
aggregate (one output row) unpivoted into a small long table.
"""
from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import exprs as X
from .cleaning import is_marker, non_currency_share
from .quantiles import join_on_keys


def missing_share(df: DataFrame, top_n: int | None = 20) -> DataFrame:
    """(column, share) of NULLs, desc, top-n (ties by column name)."""
    wide = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(c) for c in df.columns])
    out = wide.unpivot([], df.columns, "column", "share").orderBy(F.col("share").desc(), F.col("column"))
    return out.limit(top_n) if top_n else out


def profile_table(df: DataFrame, top_n: int = 20) -> DataFrame:
    """(section, name, value): number of rows and columns, columns of each type, and
    the largest shares of NULLs (ties by name); one aggregate."""
    types: dict[str, int] = {}
    for f in df.schema.fields:
        types[f.dataType.simpleString()] = types.get(f.dataType.simpleString(), 0) + 1
    nulls = [F.struct((-F.avg(F.col(f"`{c}`").isNull().cast("double"))).alias("neg"), F.lit(c).alias("name")) for c in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.array(*nulls)).alias("shares"))
    row = lambda section, name, value: F.struct(F.lit(section).alias("section"), name.alias("name"), value.cast("double").alias("value"))
    fixed = [row("shape", F.lit("rows"), F.col("n")), row("shape", F.lit("columns"), F.lit(len(df.columns))),
             *[row("type", F.lit(t), F.lit(k)) for t, k in types.items()]]
    missing = F.transform(F.slice("shares", 1, top_n), lambda s: row("missing", s["name"], F.abs(s["neg"])))
    return one.select(F.inline(F.concat(F.array(*fixed), missing)))


def _pct(share) -> F.Column:
    return F.concat(F.format_number(share * 100, 1), F.lit("%"))


def data_health(df: DataFrame, prefix: str = "", markers: Iterable[str] | None = None,
                comments: dict = C.KEY_COLUMN_COMMENTS) -> DataFrame:
    """Column, dtype, share_nan, share_unknown_marker, comment."""
    strings = set(X.string_columns(df))
    aggs = []
    for c in df.columns:
        aggs.append(F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(f"{c}__nan"))
        mk = F.coalesce(is_marker(F.col(f"`{c}`"), markers), F.lit(False)).cast("double") if c in strings else F.lit(0.0)
        aggs.append(F.avg(mk).alias(f"{c}__mk"))
    wide = df.agg(*aggs)
    entries = [F.struct(F.lit(f"{prefix}{c}").alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                        F.coalesce(F.col(f"`{c}__nan`"), F.lit(0.0)).alias("share_nan"),
                        F.coalesce(F.col(f"`{c}__mk`"), F.lit(0.0)).alias("share_unknown_marker"),
                        F.lit(comments.get(c)).alias("base"))
               for c in df.columns]
    long = wide.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    parts = F.array_compact(F.array(
        F.col("base"),
        F.when(F.col("share_nan") > 0, F.concat(F.lit("NaN "), _pct(F.col("share_nan")))),
        F.when(F.col("share_unknown_marker") > 0, F.concat(F.lit("text marker "), _pct(F.col("share_unknown_marker"))))))
    return long.withColumn("comment", F.when(F.size(parts) > 0, F.array_join(parts, "; ")).otherwise("clean")) \
               .drop("base")


def check_unique_id(df: DataFrame, id_col: str = "vacancy_id") -> DataFrame:
    """One row (is_unique, duplicate_count); all NULL ids count as one value."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(id_col).alias("d"),
                 F.max(F.col(id_col).isNull().cast("long")).alias("has_null"))
    dup = (F.col("n") - F.col("d") - F.coalesce(F.col("has_null"), F.lit(0))).cast("long")
    return row.select((dup == 0).alias("is_unique"), dup.alias("duplicate_count"))


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row (rows, distinct_rows, duplicate_rows) over full-row equality."""
    use = list(cols or df.columns)
    g = df.groupBy(*use).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.sum("_c").cast("long").alias("rows"), F.count(F.lit(1)).alias("distinct_rows")) \
            .withColumn("duplicate_rows", F.col("rows") - F.col("distinct_rows"))


def unknown_share(c: str) -> F.Column:
    """Share of NULL or "unknown" (any case)."""
    return F.avg((F.lower(F.coalesce(F.col(c), F.lit("unknown"))) == "unknown").cast("double"))


SALARY_COLUMNS = ("salary_mid_rub_capped", "salary_mid", "salary_from", "salary_to")


def stage_summary(name: str, df: DataFrame, weight_col: str | None = None, salary_cols: Sequence[str] = SALARY_COLUMNS,
                  currency_col: str = "currency", mode_col: str = "work_mode") -> DataFrame:
    """One row per stage: rows, columns, share of rows with any salary, share not in
    roubles (no currency counts as not), share of remote or hybrid work, share of unknown
    work mode.  Remote work is told by the work mode, else by ``is_remote``, else by the
    mean of ``remote_share``, weighted by ``weight_col`` where that is given and positive.
    What a table has no columns for is NULL."""
    null = F.lit(None).cast("double")
    salary = [F.col(c).isNotNull() for c in salary_cols if c in df.columns]
    mode = F.lower(F.coalesce(F.col(mode_col), F.lit("unknown"))) if mode_col in df.columns else None
    if mode is not None:
        remote = F.avg(mode.isin("remote", "hybrid").cast("double"))
    elif "is_remote" in df.columns:
        remote = X.flag_share("is_remote")
    elif "remote_share" in df.columns:
        remote = F.avg("remote_share")
        if weight_col and weight_col in df.columns:
            weight = F.col(weight_col).cast("double")
            total = F.sum(weight)
            remote = F.when(total > 0, F.try_divide(F.sum(F.col("remote_share") * weight), total)).otherwise(remote)
    else:
        remote = null
    return df.agg(
        F.lit(name).alias("stage"), F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"),
        (F.avg(reduce(lambda a, b: a | b, salary).cast("double")) if salary else null).alias("salary_share"),
        (F.avg((F.coalesce(F.col(currency_col), F.lit("")) != "RUB").cast("double")) if currency_col in df.columns else null).alias("non_rub_share"),
        remote.alias("remote_share"), (F.avg((mode == "unknown").cast("double")) if mode is not None else null).alias("unknown_share"))


def stage_table(stages: Sequence[tuple[str, DataFrame]], **kw) -> DataFrame:
    frames = [stage_summary(n, d, **kw) for n, d in stages]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def validate_clean(df: DataFrame, boolean_cols: Sequence[str] = ("salary_gross",), id_col: str = "vacancy_id",
                   age_col: str = "vacancy_age_days", markers: Iterable[str] | None = None, dropped_cols: Sequence[str] = ()) -> DataFrame:
    """Q-2: invariants of the clean table in one aggregate (and one of the ids alone),
    returned as one row: also that none of the columns dropped for missing values is left."""
    from pyspark.sql import types as T
    bool_ok = all(isinstance(df.schema[c].dataType, T.BooleanType) for c in boolean_cols if c in df.columns)
    strings = X.string_columns(df)
    left = [F.sum(F.coalesce(is_marker(F.col(c), markers), F.lit(False)).cast("long")) for c in strings]
    aggs = [F.count(F.lit(1)).alias("rows"),
            (sum(left[1:], left[0]) if left else F.lit(0)).cast("long").alias("markers_left"),
            (F.count(age_col) > 0 if age_col in df.columns else F.lit(False)).alias("age_present"),
            non_currency_share(df).alias("non_rub_share")]
    out = df.agg(*aggs)
    if id_col in df.columns:   # ids on their own: beside them every other sum would be shuffled once an id
        ids = df.agg((F.count(F.lit(1)) - F.countDistinct(id_col)).cast("long").alias("duplicate_ids"))
        out = join_on_keys(out, ids, [])
    return out.withColumns({"booleans_ok": F.lit(bool_ok), "dropped_left": F.lit(sum(c in df.columns for c in dropped_cols))})
