"""Binding of the vacancy operators to the driver's TPC-H-like tables.

A line item plays the vacancy: the part name is the title (adjectives become
``skill_*`` flags and nouns ``role_*`` flags through the keyword operator),
the part brand is the company, the extended price is the salary, the
supplier's nation is the city and its region the city tier, the part type is
the grade.  Everything is derived by Spark from the tables, so the work grows
with them.  ``VACANCY_SQL`` is the same view written for DuckDB (the oracle).

Joins: lineitem ⋈ part and lineitem ⋈ supplier are fact ⋈ dimension joins
whose dimension grows with the scale factor, so no broadcast is forced; AQE
switches to a broadcast join at run time when the measured side is small.
``nation`` (25 rows) and ``region`` (5 rows) are fixed-size by the TPC-H
specification and are broadcast explicitly.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import features as FE
from ..operators.cleaning import salary_prepare

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

# Fixed binding dictionaries (part-name words → flags).
ADJECTIVE_FLAGS = {f"skill_{w}": [w] for w in ["small", "hot", "red", "blue", "large", "old", "cold", "new"]}
NOUN_FLAGS = {f"role_{w}": [w] for w in ["widget", "gear", "plate", "bolt", "rod", "ring", "gizmo", "anvil"]}
DOMAIN_FLAGS = {"domain_color": ["red", "blue"], "domain_temperature": ["hot", "cold"],
                "domain_size": ["small", "large"], "domain_age": ["old", "new"]}
ROLE_PRIORITY = ["role_anvil", "role_bolt", "role_gear", "role_gizmo", "role_plate", "role_ring", "role_rod",
                 "role_widget"]
# Nations that stand for cities of each tier; the others keep their name.
NATION_CITY = {"RUSSIA": "Москва", "CHINA": "Moscow Region", "FRANCE": "Санкт-Петербург", "GERMANY": "Казань",
               "INDIA": "Novosibirsk", "IRAN": "Алматы", "IRAQ": "Kazakhstan"}
# Word parts of the documents that stand for skills (the Russian dictionaries find nothing there).
TEXT_SKILLS = {"skill_sql": ["thing"], "skill_excel": ["blees"], "skill_powerbi": ["ciónes"], "skill_tableau": ["lich"],
               "skill_r": [" r "], "skill_airflow": ["eauou"]}
TEXT_TECH = {"has_python": ["hein"], "has_airflow": ["eren"], "has_sklearn": ["ungen"], "has_pytorch": ["leoi"], "has_tensorflow": ["mente"],
             "has_spark": ["wher"], "has_kafka": ["sterea"]}
GRADE_OF_TYPE = {"SMALL": "intern", "ECONOMY": "junior", "MEDIUM": "middle", "LARGE": "senior", "STANDARD": "lead"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vacancy_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-stage vacancy table at line-item grain (flags from the title text)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    title = F.col("p_name")
    flags = {**TX.keyword_flags(title, ADJECTIVE_FLAGS), **TX.keyword_flags(title, NOUN_FLAGS),
             **TX.keyword_flags(title, DOMAIN_FLAGS)}
    # the title's flags depend on the part alone: they are made before the join
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", *[c.alias(n) for n, c in flags.items()])
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    geo = F.broadcast(table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")),
                                                          F.col("n_regionkey") == F.col("r_regionkey"))
                      .select("n_nationkey", "n_name", "r_name"))
    # suppliers first: should both joins shuffle, the rows are still narrow in the first
    j = (li.join(supp, li.l_suppkey == supp.s_suppkey)
           .join(part, li.l_partkey == part.p_partkey)
           .join(geo, F.col("s_nationkey") == F.col("n_nationkey")))
    grade = F.coalesce(F.create_map(*[x for k, v in GRADE_OF_TYPE.items() for x in (F.lit(k), F.lit(v))])[F.col("p_type")],
                       F.lit("unknown"))
    ln = F.col("l_linenumber")
    cols = {
        "vacancy_id": F.col("l_orderkey") * 10 + ln,
        "title": title,
        "company": F.col("p_brand"),
        "city": F.col("n_name"),
        "city_tier": F.col("r_name"),
        "currency": F.when(F.col("l_returnflag") == "R", "USD").otherwise("RUB"),
        "salary_mid": F.col("l_extendedprice"),
        "grade": grade,
        "exp_min_years": F.when(F.col("p_size") % 7 == 0, F.lit(None)).otherwise(F.floor(F.col("p_size") / 8)).cast("long"),
        "exp_max_years": F.floor(F.col("p_size") / 5).cast("long"),
        "exp_is_no_experience": F.col("p_size") <= 3,
        "is_remote": F.when(ln == 7, F.lit(None).cast("boolean")).otherwise(F.col("l_linestatus") == "O"),
        "is_hybrid": F.col("l_returnflag") == "A",
        "is_for_juniors": F.when(ln == 6, F.lit(None).cast("boolean")).otherwise(F.col("l_quantity") < 5),
        "allows_students": F.col("p_size") < 5,
        "has_mentoring": ln == 1,
        "has_test_task": F.col("l_discount") == 0,
        "has_discount": F.col("l_discount") >= 0.05,
        "has_tax": F.col("l_tax") >= 0.04,
        "has_bulk": F.col("l_quantity") >= 25,
        "benefit_low_tax": F.col("l_tax") < 0.02,
        "benefit_big_discount": F.col("l_discount") > 0.08,
        "benefit_small_order": F.col("l_quantity") <= 5,
        "soft_rich": F.col("s_acctbal") > 5000,
        "soft_debt": F.col("s_acctbal") < 0,
        "soft_even": F.col("s_suppkey") % 2 == 0,
        "employer_rating": F.round(F.col("s_acctbal") / 2000, 2),
        "published_at_iso": F.col("l_shipdate").cast("timestamp"),
        **{n: F.col(n) for n in flags},
    }
    return j.select(*[c.alias(n) for n, c in cols.items()])


def vacancy_features(spark: SparkSession, sf_dir: str, salary_bucket: bool = False,
                     raw: DataFrame | None = None) -> DataFrame:
    """Feature-stage table: C11 measure, then the F-operators with the binding's
    role priority, plus the primary domain (column order).  ``raw`` lets a caller
    pass a written raw stage so the clip quantiles and the stage share one join."""
    raw = raw if raw is not None else vacancy_raw(spark, sf_dir)
    df = salary_prepare(raw, "salary_mid", "currency", "RUB")
    df = FE.add_work_mode(df)
    df = FE.add_boolean_counts(df)
    df = FE.add_stack_aggregates(df)
    df = FE.add_experience_flags(df)
    df = FE.add_grade_from_experience(df)
    df = FE.add_grade_final(df)
    df = FE.add_primary_role(df, priority=ROLE_PRIORITY)
    df = FE.add_domain(df)
    if salary_bucket:
        df = FE.add_salary_bucket(df)
    return df


def _flag_sql(col: str, mapping: dict) -> str:
    parts = []
    for flag, pats in mapping.items():
        cond = " OR ".join(f"contains(lower({col}), '{p.lower()}')" for p in pats)
        parts.append(f"({cond}) AS {flag}")
    return ",\n       ".join(parts)


def _count_true_sql(cols) -> str:
    return " + ".join(f"CAST(coalesce({c}, false) AS INTEGER)" for c in cols)


_SKILL = list(ADJECTIVE_FLAGS)
_ROLE = list(NOUN_FLAGS)
_DOMAIN = list(DOMAIN_FLAGS)
_HAS = ["has_mentoring", "has_test_task", "has_discount", "has_tax", "has_bulk"]
_BENEFIT = ["benefit_low_tax", "benefit_big_discount", "benefit_small_order"]
_SOFT = ["soft_rich", "soft_debt", "soft_even"]

VACANCY_RAW_SQL = f"""
SELECT l.l_orderkey * 10 + l.l_linenumber AS vacancy_id,
       p.p_name AS title, p.p_brand AS company, n.n_name AS city, r.r_name AS city_tier,
       CASE WHEN l.l_returnflag = 'R' THEN 'USD' ELSE 'RUB' END AS currency,
       l.l_extendedprice AS salary_mid,
       CASE p.p_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in GRADE_OF_TYPE.items())} ELSE 'unknown' END AS grade,
       CASE WHEN p.p_size % 7 = 0 THEN NULL ELSE CAST(floor(p.p_size / 8) AS BIGINT) END AS exp_min_years,
       CAST(floor(p.p_size / 5) AS BIGINT) AS exp_max_years,
       p.p_size <= 3 AS exp_is_no_experience,
       CASE WHEN l.l_linenumber = 7 THEN NULL ELSE l.l_linestatus = 'O' END AS is_remote,
       l.l_returnflag = 'A' AS is_hybrid,
       CASE WHEN l.l_linenumber = 6 THEN NULL ELSE l.l_quantity < 5 END AS is_for_juniors,
       p.p_size < 5 AS allows_students,
       l.l_linenumber = 1 AS has_mentoring,
       l.l_discount = 0 AS has_test_task,
       l.l_discount >= 0.05 AS has_discount,
       l.l_tax >= 0.04 AS has_tax,
       l.l_quantity >= 25 AS has_bulk,
       l.l_tax < 0.02 AS benefit_low_tax,
       l.l_discount > 0.08 AS benefit_big_discount,
       l.l_quantity <= 5 AS benefit_small_order,
       s.s_acctbal > 5000 AS soft_rich,
       s.s_acctbal < 0 AS soft_debt,
       s.s_suppkey % 2 = 0 AS soft_even,
       round(s.s_acctbal / 2000, 2) AS employer_rating,
       CAST(l.l_shipdate AS TIMESTAMP) AS published_at_iso,
       {_flag_sql('p.p_name', ADJECTIVE_FLAGS)},
       {_flag_sql('p.p_name', NOUN_FLAGS)},
       {_flag_sql('p.p_name', DOMAIN_FLAGS)}
FROM lineitem l
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

_GRADE_EXP = """CASE WHEN coalesce(exp_is_no_experience, false) THEN 'intern'
            WHEN coalesce(exp_min_years, exp_max_years) IS NULL THEN 'unknown'
            WHEN coalesce(exp_min_years, exp_max_years) < 1 THEN 'intern'
            WHEN coalesce(exp_min_years, exp_max_years) < 3 THEN 'junior'
            WHEN coalesce(exp_min_years, exp_max_years) < 5 THEN 'middle'
            WHEN coalesce(exp_min_years, exp_max_years) < 8 THEN 'senior'
            ELSE 'lead' END"""

VACANCY_SQL = f"""
WITH raw AS ({VACANCY_RAW_SQL}),
caps AS (
  SELECT quantile_cont(CASE WHEN currency = 'RUB' THEN salary_mid END, 0.01) AS lo,
         quantile_cont(CASE WHEN currency = 'RUB' THEN salary_mid END, 0.99) AS hi FROM raw),
prep AS (
  SELECT raw.*, CASE WHEN currency = 'RUB' THEN salary_mid END AS salary_mid_rub,
         (CASE WHEN currency = 'RUB' THEN salary_mid END) IS NOT NULL AS salary_known,
         CASE WHEN currency <> 'RUB' THEN NULL WHEN caps.lo IS NULL THEN salary_mid
              ELSE least(greatest(salary_mid, caps.lo), caps.hi) END AS salary_mid_rub_capped
  FROM raw, caps)
SELECT prep.*,
       CASE WHEN coalesce(is_remote, false) THEN 'remote' WHEN coalesce(is_hybrid, false) THEN 'hybrid'
            ELSE 'unknown' END AS work_mode,
       {_count_true_sql(_BENEFIT)} AS benefits_count,
       {_count_true_sql(_SOFT)} AS soft_skills_count,
       {_count_true_sql(_HAS)} AS hard_stack_count,
       {_count_true_sql(_SKILL)} AS skills_count,
       {_count_true_sql(_ROLE)} AS role_count,
       0 AS core_data_skills_count, 0 AS ml_stack_count,
       {_count_true_sql(_HAS + _SKILL)} AS tech_stack_size,
       (coalesce(is_for_juniors, false) OR coalesce(allows_students, false)
        OR coalesce(exp_is_no_experience, false)) AS is_junior_friendly,
       NOT (coalesce(is_for_juniors, false) OR coalesce(allows_students, false)
        OR coalesce(exp_is_no_experience, false)) AS battle_experience,
       {_GRADE_EXP} AS grade_from_experience,
       CASE WHEN grade = 'unknown' THEN {_GRADE_EXP} ELSE grade END AS grade_final,
       CASE {' '.join(f"WHEN {c} THEN '{c[5:]}'" for c in ROLE_PRIORITY)} ELSE 'other' END AS primary_role,
       CASE {' '.join(f"WHEN {c} THEN '{c[7:]}'" for c in _DOMAIN)} ELSE 'unknown' END AS domain
FROM prep
"""


def vacancy_cte(name: str = "v") -> str:
    """``WITH v AS (...)`` prefix for oracle queries over the feature view."""
    return f"WITH {name} AS ({VACANCY_SQL})\n"
