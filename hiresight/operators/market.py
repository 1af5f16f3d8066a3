"""Aggregated market view (A27) with its top-skills text (A28) and the optional
complete key grid (J7).

One ``groupBy`` over the feature table computes counts, flag shares and every
skill share (partial aggregation: one row per segment per task is shuffled);
the salary quartiles and the median stack size are two distributed quantile
selections, each over its own column and the keys.  All results are one row per
segment and are joined on the segment keys.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import exprs as X
from .quantiles import grouped_quantiles, join_on_keys
from .segments import drop_null_keys, primary_label


def top_skills_text(shares: Sequence[tuple[str, Column]], k: int = 5, prefixes=("skill_", "has_")) -> Column:
    """A28: "name (NN%)" for the k largest positive shares (ties by name), joined
    by ", "; empty string when no share is positive."""
    def clean(name: str) -> str:
        for p in prefixes:
            if name.startswith(p):
                return name.replace(p, "")
        return name
    if not shares:
        return F.lit("")
    arr = F.array(*[F.struct((-s).alias("neg"), F.lit(clean(n)).alias("name")) for n, s in shares])
    top = F.slice(F.sort_array(F.filter(arr, lambda e: e["neg"] < 0)), 1, k)
    return F.array_join(F.transform(top, lambda e: F.concat(e["name"], F.lit(" ("),
                                                            F.format_number(-e["neg"] * 100, 0), F.lit("%)"))), ", ")


def build_market_view(df: DataFrame, measure: str = C.DEFAULT_MEASURE,
                      keys: Sequence[str] = ("primary_role", "grade", "city_tier"), domain_prefix: str = "domain_",
                      skill_cols: Sequence[str] | None = None, exclude_non_skills: Sequence[str] = C.NON_SKILL_HAS,
                      top_k: int = 5, complete_grid: bool = False, quantile_method: str = "exact") -> DataFrame:
    keys = list(keys)
    X.require_columns(df, [*keys, measure], "build_market_view")
    t = df
    domain_cols = [c for c in df.columns if c.startswith(domain_prefix)]
    if domain_cols:
        t = t.withColumn("domain", primary_label(domain_cols, domain_prefix))
        keys = keys + ["domain"]
    if "is_junior_friendly" in df.columns:
        jf = F.coalesce(F.col("is_junior_friendly").cast("boolean"), F.lit(False))
    elif "battle_experience" in df.columns:
        jf = ~F.coalesce(F.col("battle_experience").cast("boolean"), F.lit(False))
    else:
        jf = F.lit(None).cast("boolean")
    if "is_remote" in df.columns:
        rf = F.coalesce(F.col("is_remote").cast("boolean"), F.lit(False))
    elif "work_mode" in df.columns:
        rf = F.lower(F.coalesce(F.col("work_mode"), F.lit(""))).isin("remote", "hybrid")
    else:
        rf = F.lit(None).cast("boolean")
    stack = F.col("tech_stack_size").cast("double") if "tech_stack_size" in df.columns else X.typed_null("double")
    if skill_cols is None:
        bools = set(X.bool_columns(df))
        skill_cols = [c for c in df.columns if (c.startswith("skill_") or c.startswith("has_")) and c in bools
                      and c not in set(exclude_non_skills)]
    t = drop_null_keys(t.withColumns({"_jf": jf.cast("double"), "_rf": rf.cast("double"), "_stack": stack}), keys)

    aggs = [F.count(F.col(measure)).alias("vacancy_count"), F.avg("_jf").alias("junior_friendly_share"),
            F.avg("_rf").alias("remote_share")]
    aggs += [X.flag_share(c).alias(f"_s_{c}") for c in skill_cols]
    main = t.groupBy(*keys).agg(*aggs)
    main = main.withColumn("top_skills", top_skills_text([(c, F.col(f"_s_{c}")) for c in skill_cols], top_k)) \
               .drop(*[f"_s_{c}" for c in skill_cols])

    salary = grouped_quantiles(t, measure, [0.25, 0.5, 0.75], keys, ["salary_q25", "salary_median", "salary_q75"], quantile_method)
    sizes = grouped_quantiles(t, "_stack", [0.5], keys, ["median_tech_stack_size"], quantile_method)
    out = join_on_keys(join_on_keys(main, salary, keys), sizes, keys)
    cols = keys + ["vacancy_count", "salary_median", "salary_q25", "salary_q75", "junior_friendly_share",
                   "remote_share", "median_tech_stack_size", "top_skills"]
    out = out.select(*cols)
    if complete_grid:
        out = complete_key_grid(out, t, keys, {"vacancy_count": 0})
    return out.orderBy(F.col("vacancy_count").desc(), *keys)


def complete_key_grid(result: DataFrame, source: DataFrame, keys: Sequence[str], fill: dict) -> DataFrame:
    """Every combination of the observed key values (pandas ``observed=False``).

    The combinations are the result that is asked for; they are made from the
    distinct values of each key, which are aggregated before any shuffle, and
    the computed cells are joined onto them."""
    keys = list(keys)
    grid = None
    for k in keys:
        own = source.select(k).where(F.col(k).isNotNull()).distinct()
        grid = own if grid is None else grid.crossJoin(own)
    return join_on_keys(grid, result, keys, "left").fillna(fill)
