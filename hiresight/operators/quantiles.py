"""Exact grouped quantiles that never funnel one group through one task.

``percentile``/``median`` keep a value->count map per group and merge all of a
group's maps in one reducer; a group holding a third of 100 TB would not fit.
Here the exact linear-interpolated quantile (pandas ``quantile``, DuckDB
``quantile_cont``) comes from two pre-aggregated passes over keys and value:

1. per group, the count and, for each wanted rank, a bracket of two values from
   one bounded sketch (``percentile_approx``, whose rank error is guaranteed);
2. rows inside a bracket are counted by value, rows between two brackets together;
   each row counts once, whatever the number of quantiles; a hot value or a hot
   group is one row per task, and what crosses the shuffle is the few
   ten-thousandths of a group inside brackets;
3. a running count over those values finds the wanted ranks.

The brackets (one row per group) reach pass 2 as a local table where they are
checked to be few, else as an ordinary join.  There are no row ids, no
checkpoint and no shuffle of the rows themselves.

``method="approx"`` uses ``percentile_approx`` alone for callers that accept a
rank error.
"""
from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Results of so few rows are made local and broadcast in joins.
LOCAL_ROWS = 10_000


def localized(df: DataFrame, most: int = LOCAL_ROWS) -> DataFrame:
    """``df`` as a local table if it has at most ``most`` rows (they are computed
    now); else ``df`` itself.  Spark doesn't know the size of a table made from rows,
    so it is marked for broadcast: a join would else deal the other side's rows out by
    key, a whole group to one task."""
    rows = df.limit(most + 1).collect()
    return df if len(rows) > most else F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def _names(probs: Sequence[float], names: Sequence[str] | None) -> list[str]:
    if names is not None:
        if len(names) != len(probs):
            raise ValueError("names and probs differ in length")
        return list(names)
    return [f"q{round(p * 100):02d}" for p in probs]


def grouped_quantiles(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (),
                      names: Sequence[str] | None = None, method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """One row per group that has at least one non-NULL value: keys + quantiles.

    NULL and NaN values are skipped (pandas semantics).  Groups are formed on ``keys``
    as given, NULL keys included; callers drop them first when they follow
    pandas ``groupby``.
    """
    keys = list(keys)
    probs = [float(p) for p in probs]
    out_names = _names(probs, names)
    base = df.select(*[F.col(k) for k in keys], F.col(value).cast("double").alias("_v")) \
             .where(F.col("_v").isNotNull() & ~F.isnan("_v"))

    if method == "approx":
        aggs = [F.percentile_approx("_v", p, accuracy).alias(n) for p, n in zip(probs, out_names)]
        return base.groupBy(*keys).agg(*aggs) if keys else base.agg(*aggs)
    if method != "exact":
        raise ValueError(f"unknown quantile method {method!r}")

    if not probs:
        return base.select(*keys).distinct()

    # The sketch's rank error is 1/accuracy of the group.  A bracket must reach two
    # ranks past it, so small groups take a wide one, and the smallest all values.
    wide, least = 0.04, 100
    margins = (4.0 / accuracy, wide)
    edges = [min(1.0, max(0.0, p + side * m)) for p in probs for m in margins for side in (-1, 1)]
    aggs = [F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", edges, accuracy).alias("_e"),
            F.min("_v").alias("_min"), F.max("_v").alias("_max")]
    groups = localized((base.groupBy(*keys).agg(*aggs) if keys else base.agg(*aggs)).where(F.col("_n") > 0))

    def edge(i: int, p: float, side: int, last: str):
        narrow, broad = (F.col("_e")[4 * i + 2 * k + (side > 0)] for k in (0, 1))
        inside = [0 < p + side * m < 1 for m in margins]
        return F.when((F.col("_n") >= accuracy) & F.lit(inside[0]), narrow) \
            .when(F.col("_n").between(least, accuracy - 1) & F.lit(inside[1]), broad).otherwise(F.col(last))

    v = F.col("_v")
    brackets = [(edge(i, p, -1, "_min"), edge(i, p, 1, "_max")) for i, p in enumerate(probs)]
    inside = reduce(lambda a, b: a | b, [(v >= lo) & (v <= hi) for lo, hi in brackets])
    passed = sum(((v > hi).cast("int") for _, hi in brackets), F.lit(0))
    # a row counts once: under its value inside brackets, else with all rows between the same two brackets
    placed = join_on_keys(base, groups, keys, "inner") \
        .groupBy(*keys, F.when(inside, v).alias("_in"), F.when(~inside, passed).alias("_gap")) \
        .agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_at"))
    run = Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    ranked = join_on_keys(placed.withColumn("_upto", F.sum("_c").over(run)), groups.select(*keys, "_n"), keys, "inner")

    aggs = [F.max("_n").alias("_n")]
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1).cast("double") * F.lit(p)
        for name, rank in ((f"_lo{i}", F.floor(pos)), (f"_hi{i}", F.ceil(pos))):
            aggs.append(F.min(F.when(F.col("_upto") > rank, F.col("_at"))).alias(name))
    vals = ranked.groupBy(*keys).agg(*aggs) if keys else ranked.agg(*aggs).where(F.col("_n") > 0)

    outs = []
    for i, (p, n) in enumerate(zip(probs, out_names)):
        pos = (F.col("_n") - 1).cast("double") * F.lit(p)
        frac = pos - F.floor(pos)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        outs.append(F.when(frac == 0, lo).otherwise(lo + (hi - lo) * frac).alias(n))
    return vals.select(*keys, *outs)


def global_quantiles(df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str] | None = None,
                     method: str = "exact") -> DataFrame:
    """One-row frame of quantiles over the whole column (no row if all NULL)."""
    return grouped_quantiles(df, value, probs, (), names, method)


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Null-safe equi-join on same-named keys; the right side's keys are dropped."""
    keys = list(keys)
    if not keys:
        # both sides are one-row global aggregates: join on a constant key,
        # broadcasting the one-row right side
        return left.withColumn("_ck", F.lit(0)).join(
            F.broadcast(right.withColumn("_ck", F.lit(0))), "_ck", how).drop("_ck")
    renamed = right
    for i, k in enumerate(keys):
        renamed = renamed.withColumnRenamed(k, f"_rk{i}")
    cond = None
    for i, k in enumerate(keys):
        c = left[k].eqNullSafe(renamed[f"_rk{i}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"_rk{i}" for i in range(len(keys))])
