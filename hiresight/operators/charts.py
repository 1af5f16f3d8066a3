"""Chart-ready tables (the data behind each figure; drawing is not built).

Matrices are returned long (row key, column key, value); ``pivot_long`` gives
the wide form on the small result when a caller wants it.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import exprs as X
from ..functions.text import humanize_flag
from .quantiles import grouped_quantiles, join_on_keys, localized
from .segments import drop_null_keys, hard_skill_columns, restrict_to_top, segment_summary, stack_bucket


def box_stats(df: DataFrame, key: str, measure: str = C.DEFAULT_MEASURE, top_n: int | None = None,
              order: Sequence[str] | None = None) -> DataFrame:
    """V1: quartiles and 1.5·IQR whiskers per category (matplotlib's rule):
    whisker_low/high = min/max of values inside the fences, outliers counted.
    Quartiles are one grouped selection; the fences are joined back to the rows
    on the key (one row per category, local where they are few, so the rows aren't
    shuffled) and a second aggregate finds whiskers."""
    src = restrict_to_top(df, key, top_n) if top_n else drop_null_keys(df, [key])
    q = localized(grouped_quantiles(src, measure, [0.25, 0.5, 0.75], [key], ["q1", "median", "q3"]))
    fences = q.withColumn("_lo", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
              .withColumn("_hi", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    m = F.col(measure).cast("double")
    j = src.select(key, m.alias("_m")).where(F.col("_m").isNotNull()).join(fences.select(key, "_lo", "_hi"), key)
    inside = (F.col("_m") >= F.col("_lo")) & (F.col("_m") <= F.col("_hi"))
    w = j.groupBy(key).agg(F.min(F.when(inside, F.col("_m"))).alias("whisker_low"),
                           F.max(F.when(inside, F.col("_m"))).alias("whisker_high"),
                           F.count_if(~inside).alias("outliers"), F.count(F.lit(1)).alias("n"))
    out = q.join(w, key)
    if order:
        out = out.orderBy(X.order_rank(key, order), F.col(key))
    return out


def crosstab_shares(df: DataFrame, row_key: str = "city_tier", col_key: str = "work_mode") -> DataFrame:
    """V3: row-normalised cross-tab, long (row, col, share); the normalising sum
    is a window over the small grouped frame."""
    g = drop_null_keys(df, [row_key, col_key]).groupBy(row_key, col_key).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(row_key))).drop("n")


def top_skills_for_role(df: DataFrame, role_filter: str = "data", skill_cols: Sequence[str] | None = None,
                        top_n: int = 15, role_col: str = "primary_role") -> DataFrame:
    """Rows whose role contains the filter (case-insensitive, literal);
    count and share of each skill; top-n by count."""
    cols = list(skill_cols) if skill_cols is not None else hard_skill_columns(df)
    sub = df.where(F.coalesce(F.lower(F.col(role_col)).contains(role_filter.lower()), F.lit(False)))
    wide = sub.agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(X.flag_int(c).cast("long")).alias(c) for c in cols])
    long = wide.unpivot(["_rows"], cols, "skill", "count")
    return long.select("skill", F.col("count").cast("long").alias("count"),
                       X.safe_div("count", "_rows").alias("share")) \
               .where(F.col("share").isNotNull()) \
               .orderBy(F.col("count").desc(), F.col("skill")).limit(top_n)


def skill_heatmap(df: DataFrame, index_col: str, skill_cols: Sequence[str] | None = None, top_n: int = 20) -> DataFrame:
    """V9/T4: the top-n skills by overall mean (NULLs skipped), then their mean
    per segment (empty cells 0), long (segment, skill, share).  The ≤ top_n
    chosen names are the only thing brought to the driver."""
    cols = [c for c in (hard_skill_columns(df) if skill_cols is None else skill_cols) if c in df.columns]
    means = df.agg(*[X.flag_share(c, False).alias(c) for c in cols]).unpivot([], cols, "skill", "m") \
              .orderBy(F.col("m").desc_nulls_last(), F.col("skill")).limit(top_n).collect()
    top = [r["skill"] for r in means]
    wide = drop_null_keys(df, [index_col]).groupBy(index_col).agg(*[X.flag_share(c, False).alias(c) for c in top])
    return wide.unpivot([index_col], top, "skill", "share").fillna(0.0, ["share"])


def employer_flag_heatmap(df: DataFrame, company_col: str = "company", prefix: str = "benefit_",
                          top_n_employers: int = 10, top_n_flags: int = 12) -> DataFrame:
    """Top employers × top flags, flags ranked by the mean of the
    employers' shares; long (company, flag, share)."""
    flags = X.bool_columns(df, prefix)
    sub = restrict_to_top(df, company_col, top_n_employers)
    wide = sub.groupBy(company_col).agg(*[X.flag_share(c).alias(c) for c in flags])
    long = wide.unpivot([company_col], flags, "flag", "share")
    rank = long.groupBy("flag").agg(F.avg("share").alias("_m")) \
               .withColumn("_r", F.row_number().over(Window.orderBy(F.col("_m").desc(), F.col("flag")))) \
               .where(F.col("_r") <= top_n_flags).select("flag")
    return long.join(F.broadcast(rank), "flag").select(company_col, "flag", "share")


def mean_and_count(df: DataFrame, category_col: str, measure: str = C.DEFAULT_MEASURE, top_n: int = 10,
                   order: Sequence[str] | None = None) -> DataFrame:
    """Median, mean, count per category; top-n by count (then the given
    display order, e.g. grades)."""
    out = segment_summary(df, [category_col], measure, ["median", "mean", "count"])
    out = out.orderBy(F.col("count").desc(), F.col(category_col)).limit(top_n)
    if order:
        out = out.orderBy(X.order_rank(category_col, order), F.col(category_col))
    return out


def stack_bucket_chart(size) -> F.Column:
    """V11 chart variant: 0-2 / 3-5 / 6-10 / 10+ with NULL as 0."""
    return X.evaluated_once(F.coalesce(size.cast("double"), F.lit(0.0)),
                            lambda s: F.when(s <= 2.5, "0-2").when(s <= 5.5, "3-5").when(s <= 10.5, "6-10").otherwise("10+"))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram (numpy edges; the maximum falls in the last
    bin; a constant column gives one bin).  Non-numeric values are NULL."""
    from pyspark.sql.types import NumericType
    v = F.col(column).cast("double") if isinstance(df.schema[column].dataType, NumericType) \
        else F.col(column).cast("string").try_cast("double")
    t = df.select(v.alias("_v")).where(F.col("_v").isNotNull())
    rng = t.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    j = join_on_keys(t, rng, [])
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_v") - F.col("_lo")) / width * bins), F.lit(bins - 1))).cast("int")
    return j.withColumn("bin", b).groupBy("bin").agg(F.count(F.lit(1)).alias("count"),
                                                     F.min("_lo").alias("range_min"), F.max("_hi").alias("range_max"))


def persona_gap_chart(gap: DataFrame) -> DataFrame:
    """Missing skills only, share in percent, human-readable names."""
    return gap.where(F.col("gap")).select(humanize_flag(F.col("skill_name")).alias("label"), "skill_name",
                                          (F.col("market_share") * 100).alias("share_pct")) \
              .orderBy(F.col("share_pct").desc(), F.col("skill_name"))


def pivot_long(long: DataFrame, row_key: str, col_key: str, value: str, values: Sequence[str] | None = None) -> DataFrame:
    """Wide form of a small long matrix."""
    return long.groupBy(row_key).pivot(col_key, list(values) if values is not None else None).agg(F.first(value))
