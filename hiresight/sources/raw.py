"""Raw vacancy CSV source (S1), stage-table sink (S2) and reader (S3).

The raw schema is declared, never inferred: scalar columns are listed, and
the flag columns are generated from the keyword dictionaries that produce
them, in the collector's column order.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import exprs as X
from .csvsplit import read_csv

_S, _L, _D, _B, _TS = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType()

_HEAD = [("vacancy_id", _S), ("title", _S), ("company", _S), ("salary_from", _L), ("salary_to", _L), ("currency", _S),
         ("salary_gross", _B), ("salary_mid", _D), ("salary_range_width", _L), ("salary_is_exact", _B), ("city", _S),
         ("address", _S), ("has_metro", _B), ("metro_primary", _S), ("metro_count", _L), ("address_has_district", _B),
         ("search_area_id", _L), ("experience", _S), ("exp_min_years", _L), ("exp_max_years", _L),
         ("exp_is_no_experience", _B), ("employment_type", _S), ("schedule", _S), ("work_format_raw", _S),
         ("work_format", _S), ("is_remote", _B), ("is_hybrid", _B), ("description", _S), ("description_len_chars", _L),
         ("description_len_words", _L), ("description_bullets_count", _L), ("description_paragraphs_count", _L),
         ("requirements_count", _L), ("responsibilities_count", _L), ("optional_skills_count", _L),
         ("must_have_skills_count", _L), ("skills", _S), ("skills_count", _L), ("published_at_raw", _S),
         ("published_at_iso", _S), ("vacancy_age_days", _L), ("scraped_at_utc", _S), ("vacancy_code", _S), ("grade", _S)]
_MID = [("core_data_skills_count", _L), ("ml_stack_count", _L), ("tech_stack_size", _L)]
_EMPLOYER = [("vacancy_url", _S), ("employer_url", _S), ("employer_rating", _D), ("employer_reviews_count", _L),
             ("employer_has_remote", _B), ("employer_has_flexible_schedule", _B), ("employer_has_med_insurance", _B),
             ("employer_has_education", _B), ("employer_accredited_it", _B), ("employer_type", _S), ("edu_required", _B),
             ("edu_level", _S), ("edu_technical", _B), ("edu_math_or_cs", _B), ("lang_english_required", _B),
             ("lang_english_level", _S), ("lang_other_count", _L), ("is_for_juniors", _B), ("allows_students", _B),
             ("has_mentoring", _B), ("has_test_task", _B)]


def raw_schema() -> T.StructType:
    flags = lambda d: [(k, _B) for k in d]
    fields = (_HEAD + flags(C.ROLE_KEYWORDS) + flags(C.TECH_KEYWORDS) + flags(C.DATA_SKILL_KEYWORDS) + _MID
              + flags(C.BENEFIT_KEYWORDS) + _EMPLOYER + flags(C.SOFT_SKILL_KEYWORDS) + flags(C.DOMAIN_KEYWORDS))
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def load_raw(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read the raw CSV (multi-line quoted descriptions).  Every column is
    read as text and cast with ``try_cast`` / boolean coercion so one bad value
    becomes NULL instead of failing the job under ANSI mode."""
    schema = schema or raw_schema()
    # no inference: without a schema every column is read as text, by header name
    df = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
              .option("inferSchema", False).option("mode", "PERMISSIVE").csv(path))
    from ..operators.cleaning import bool_like_expr
    cols = []
    present = set(df.columns)
    for f in schema.fields:
        c = F.col(f"`{f.name}`") if f.name in present else F.lit(None).cast("string")
        if isinstance(f.dataType, T.BooleanType):
            cols.append(bool_like_expr(c).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            cols.append(c)
        else:
            cols.append(c.try_cast(f.dataType).alias(f.name))
    return df.select(*cols)


def save_stage(df: DataFrame, path: str, fmt: str | None = None, partition_by: list[str] | None = None) -> None:
    """Write a stage table (Parquet unless the path ends with .csv).  Before
    writing, ``salary_gross`` is forced to boolean (C5) and string columns whose
    values are all boolean-like become boolean (C6: true/yes/1, false/no/0, unknown
    markers as NULL; found in one aggregate); columns without any true or false keep
    their type."""
    from ..operators.cleaning import bool_like_expr, detect_bool_like, ensure_boolean
    out = ensure_boolean(df, "salary_gross")
    strings = X.string_columns(out)
    if strings:
        told = out.agg(*[F.count(bool_like_expr(F.col(f"`{c}`"))).alias(c) for c in strings]).first()
        like = detect_bool_like(out, [c for c in strings if told[c]])
        out = out.withColumns({c: bool_like_expr(F.col(c)) for c in like}) if like else out
    fmt = fmt or ("csv" if path.lower().endswith(".csv") else "parquet")
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """S3: read a stage table back."""
    if path.lower().endswith(".csv"):
        return read_csv(spark, path)
    return spark.read.parquet(path)
