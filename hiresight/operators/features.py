"""Feature stage (table in → table out), all as one projection chain.

Each operator adds columns with native expressions; ``assemble_features``
chains them so Catalyst collapses the chain into a single ``Project`` (plus the
tertile-edge aggregate of the salary bucket, a one-row broadcast).
"""
from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import exprs as X
from .quantiles import global_quantiles, join_on_keys
from .segments import primary_label


def detect_column_groups(df: DataFrame, prefixes: Sequence[str] = C.PREFIX_GROUPS) -> dict:
    """Boolean columns grouped by prefix (derived counters never qualify)."""
    bools = X.bool_columns(df)
    return {p: [c for c in bools if c.startswith(p)] for p in prefixes}


def experience_grade(years: Column | None, no_exp: Column | None, raw: Column | None) -> Column:
    """grade from experience flag, years, then raw text."""
    e = None
    if no_exp is not None:
        e = F.when(F.coalesce(no_exp.cast("boolean"), F.lit(False)), "intern")
    if years is not None:
        y = years.cast("double")
        for bound, label in ((1, "intern"), (3, "junior"), (5, "middle"), (8, "senior")):
            cond = y.isNotNull() & (y < bound)
            e = F.when(cond, label) if e is None else e.when(cond, label)
        e = e.when(y.isNotNull(), "lead")
    if raw is not None:
        t = F.lower(raw)
        rules = [(["не треб", "no experience", "без опыта"], "intern"), (["1-3", "1–3", "1 to 3"], "junior"),
                 (["3-6", "3–6", "3 to 6"], "middle"), (["6"], "senior")]
        for toks, label in rules:
            cond = F.coalesce(X.contains_any(t, toks), F.lit(False))
            e = F.when(cond, label) if e is None else e.when(cond, label)
    return F.lit("unknown") if e is None else e.otherwise("unknown")


def add_grade_from_experience(df: DataFrame, min_col="exp_min_years", max_col="exp_max_years",
                              flag_col="exp_is_no_experience", raw_col="experience") -> DataFrame:
    has = lambda c: c in df.columns
    years = None
    if has(min_col):
        years = F.coalesce(F.col(min_col).cast("double"), F.col(max_col).cast("double")) if has(max_col) \
            else F.col(min_col)
    elif has(max_col):
        years = F.col(max_col)
    expr = experience_grade(years, F.col(flag_col) if has(flag_col) else None,
                            F.col(raw_col) if has(raw_col) else None)
    return df.withColumn("grade_from_experience", expr)


def add_time_features(df: DataFrame, date_col: str = "published_at_iso", scraped_col: str = "scraped_at_utc",
                      legacy_weekend: bool = False) -> DataFrame:
    """weekday (Monday=0), month, weekend flag, age in whole days (floor)."""
    if date_col in df.columns:
        d = F.col(date_col)
        wd = F.weekday(d)
        weekend = wd.isin(5, 6)
        if legacy_weekend:
            weekend = F.coalesce(weekend, F.lit(False))
        df = df.withColumns({"published_weekday": wd, "published_month": F.month(d), "is_weekend_post": weekend})
    else:
        df = df.withColumns({"published_weekday": X.typed_null("int"), "published_month": X.typed_null("int"),
                             "is_weekend_post": X.typed_null("boolean")})
    if scraped_col in df.columns and date_col in df.columns:
        df = df.withColumn("vacancy_age_days", age_days(F.col(date_col), F.col(scraped_col)))
    else:
        df = df.withColumn("vacancy_age_days", X.typed_null("long"))
    return df


def age_days(start: Column, end: Column) -> Column:
    """Whole days of (end - start), floored like pandas ``timedelta.days``."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.floor(micros / F.lit(86_400_000_000)).cast("long")


def city_tier_expr(city: Column, million_plus: Sequence[str] = C.CITY_MILLION_PLUS) -> Column:
    """F3."""
    c = F.lower(city)
    return (F.when(city.isNull(), "unknown")
             .when(X.contains_any(c, C.CITY_MOSCOW_TOKENS), "Moscow")
             .when(X.contains_any(c, C.CITY_SPB_TOKENS), "SPb")
             .when(c.isin(*million_plus), "Million+")
             .when(X.contains_any(c, C.CITY_KZ_TOKENS), "KZ/Other")
             .otherwise("Other RU"))


def add_city_tier(df: DataFrame, city_col: str = "city", million_plus: Sequence[str] = C.CITY_MILLION_PLUS) -> DataFrame:
    if city_col in df.columns:
        return df.withColumn("city_tier", city_tier_expr(F.col(city_col), million_plus))
    return df.withColumn("city_tier", F.lit("unknown"))


def add_work_mode(df: DataFrame, format_col="work_format", remote_col="is_remote", hybrid_col="is_hybrid") -> DataFrame:
    """explicit known format, else remote flag, else hybrid flag, else unknown."""
    e = None
    if format_col in df.columns:
        f = F.col(format_col)
        e = F.when(f.isin(*C.WORK_MODES), f)
    for c, label in ((remote_col, "remote"), (hybrid_col, "hybrid")):
        if c in df.columns:
            cond = F.coalesce(F.col(c).cast("boolean"), F.lit(False))
            e = F.when(cond, label) if e is None else e.when(cond, label)
    return df.withColumn("work_mode", F.lit("unknown") if e is None else e.otherwise("unknown"))


def add_experience_flags(df: DataFrame, flags: Sequence[str] = ("is_for_juniors", "allows_students",
                                                                "exp_is_no_experience")) -> DataFrame:
    """Junior-friendly = any flag (NULL as false); battle_experience = not."""
    present = [f for f in flags if f in df.columns]
    if not present:
        return df
    jf = X.any_true(present)
    return df.withColumns({"is_junior_friendly": jf, "battle_experience": ~jf})


BOOLEAN_COUNT_TARGETS = {"benefit_": "benefits_count", "soft_": "soft_skills_count", "has_": "hard_stack_count",
                         "skill_": "skills_count", "role_": "role_count"}


def add_boolean_counts(df: DataFrame, groups: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """per-row count of true flags per prefix group (overwrites ``skills_count``)."""
    groups = groups or detect_column_groups(df)
    new = {t: X.count_true(groups.get(p, [])) for p, t in BOOLEAN_COUNT_TARGETS.items() if groups.get(p)}
    return df.withColumns(new) if new else df


def add_stack_aggregates(df: DataFrame, core: Sequence[str] = C.CORE_DATA_SKILLS,
                         ml: Sequence[str] = C.ML_STACK_SKILLS, exclude: Sequence[str] = ()) -> DataFrame:
    """core-data, ML and total tech-stack sizes (all has_*/skill_* flags unless excluded)."""
    bools = set(X.bool_columns(df))
    tech = [c for c in df.columns if (c.startswith("has_") or c.startswith("skill_")) and c in bools
            and c not in set(exclude)]
    return df.withColumns({
        "core_data_skills_count": X.count_true([c for c in core if c in df.columns]),
        "ml_stack_count": X.count_true([c for c in ml if c in df.columns]),
        "tech_stack_size": X.count_true(tech),
    })


def primary_role_expr(df: DataFrame, priority: Sequence[str] = C.PRIMARY_ROLE_PRIORITY,
                      role_prefix: str = "role_") -> Column:
    """first role flag in priority order that is true, else "other"."""
    cols = [c for c in priority if c in df.columns]
    if not cols:
        return F.lit("other")
    return F.coalesce(*[F.when(F.coalesce(F.col(c).cast("boolean"), F.lit(False)), F.lit(c.replace(role_prefix, "", 1)))
                        for c in cols], F.lit("other"))


def add_primary_role(df: DataFrame, role_prefix: str = "role_",
                     priority: Sequence[str] = C.PRIMARY_ROLE_PRIORITY) -> DataFrame:
    return df.withColumn("primary_role", primary_role_expr(df, priority, role_prefix))


def add_grade_final(df: DataFrame, grade_col: str = "grade") -> DataFrame:
    """F8: grade unless "unknown" (NULL stays NULL), else the experience grade."""
    if grade_col in df.columns:
        g = F.col(grade_col)
        return df.withColumn("grade_final", F.when(g == "unknown", F.col("grade_from_experience")).otherwise(g))
    return df.withColumn("grade_final", F.col("grade_from_experience"))


def add_salary_bucket(df: DataFrame, measure: str = C.DEFAULT_MEASURE,
                      labels: Sequence[str] = ("low", "mid", "high")) -> DataFrame:
    """equal-frequency buckets from exact global quantile edges (one bounded
    aggregate broadcast as a one-row frame); right-closed; fewer non-NULL values
    than labels → NULL; coinciding edges merge buckets instead of failing."""
    labels = list(labels)
    if measure not in df.columns:
        df = df.withColumn(measure, X.typed_null("double"))
    k = len(labels)
    probs = [i / k for i in range(1, k)]
    names = [f"_e{i}" for i in range(1, k)]
    edges = global_quantiles(df, measure, probs, names)
    cnt = df.agg(F.count(measure).alias("_nv"))
    stats = join_on_keys(cnt, edges, [])
    t = join_on_keys(df, stats, [])
    m = F.col(measure)
    e = None
    for i, n in enumerate(names):
        cond = m <= F.col(n)
        e = F.when(cond, labels[i]) if e is None else e.when(cond, labels[i])
    e = (e.when(m.isNotNull(), labels[-1]) if e is not None else F.when(m.isNotNull(), labels[-1]))
    return t.withColumn("salary_bucket", F.when(F.col("_nv") >= k, e)).drop("_nv", *names)


def add_structured_text_features(df: DataFrame, description_col: str = "description",
                                 extra: Mapping[str, str] | None = None) -> DataFrame:
    """F16: description length (code points) and word count; word counts of any
    listed text columns that exist."""
    from ..functions.text import word_count
    extra = extra or {"requirements": "requirements_count", "responsibilities": "responsibilities_count",
                      "must_have_skills": "must_have_skills_count", "optional_skills": "optional_skills_count"}
    new = {}
    if description_col in df.columns:
        d = F.coalesce(F.col(description_col), F.lit(""))
        new["description_len_chars"] = F.length(d).cast("long")
        new["description_len_words"] = word_count(d)
    for c, t in extra.items():
        if c in df.columns:
            new[t] = word_count(F.col(c))
    return df.withColumns(new) if new else df


EXPECTED_DEFAULTS = {
    "published_weekday": ("int", None), "city_tier": ("string", "unknown"), "work_mode": ("string", "unknown"),
    "grade_from_experience": ("string", "unknown"), "grade_final": ("string", "unknown"),
    "primary_role": ("string", "other"), "salary_bucket": ("string", None), "vacancy_age_days": ("long", None),
    "core_data_skills_count": ("int", 0), "ml_stack_count": ("int", 0), "tech_stack_size": ("int", 0),
    "benefits_count": ("int", 0), "soft_skills_count": ("int", 0), "role_count": ("int", 0),
    "is_junior_friendly": ("boolean", None), "battle_experience": ("boolean", None),
}


def ensure_columns(df: DataFrame, defaults: Mapping[str, tuple] = EXPECTED_DEFAULTS) -> DataFrame:
    """add absent columns with typed defaults; present ones are untouched."""
    new = {c: F.lit(v).cast(t) for c, (t, v) in defaults.items() if c not in df.columns}
    return df.withColumns(new) if new else df


def add_domain(df: DataFrame, prefix: str = "domain_", order: Sequence[str] | None = None,
               alphabetical: bool = False, name: str = "domain") -> DataFrame:
    """F14 as a column: first true domain flag (column order, or alphabetical)."""
    cols = [c for c in df.columns if c.startswith(prefix)]
    if alphabetical:
        cols = sorted(cols)
    return df.withColumn(name, primary_label(cols, prefix, order))


def assemble_features(df: DataFrame, measure: str = C.DEFAULT_MEASURE,
                      role_priority: Sequence[str] = C.PRIMARY_ROLE_PRIORITY,
                      salary_bucket: bool = True) -> DataFrame:
    """F2 → F3 → F4 → F5 → F6 → P6 → F1 → F8 → F7 → F9 → F16 → F15."""
    groups = detect_column_groups(df)
    df = add_time_features(df)
    df = add_city_tier(df) if "city_tier" not in df.columns else df
    df = add_work_mode(df)
    df = add_boolean_counts(df, groups)
    df = add_stack_aggregates(df)
    df = add_experience_flags(df)
    df = add_grade_from_experience(df)
    df = add_grade_final(df)
    df = add_primary_role(df, priority=role_priority)
    if salary_bucket:
        df = add_salary_bucket(df, measure)
    df = add_structured_text_features(df)
    return ensure_columns(df)


def compute_skill_premium(df: DataFrame, skill_cols: Sequence[str], measure: str = C.DEFAULT_MEASURE,
                          min_count: int = 30) -> DataFrame:
    """A26 (kept here under its feature-stage name)."""
    from .segments import skill_premium
    return skill_premium(df, skill_cols, measure, min_count)
