"""The original project's literal unit cases, re-expressed on Spark."""
from pyspark.sql import Row

from hiresight.operators import cleaning, features, personas


def test_ensure_boolean_converts_and_preserves_columns(spark):
    df = spark.createDataFrame([("True", 100000.0), ("False", 150000.0), ("unknown", None), ("yes", 200000.0),
                                ("no", 50000.0)], "salary_gross string, salary_from double")
    out = cleaning.ensure_boolean(df, "salary_gross")
    assert set(out.columns) == set(df.columns)
    assert dict(out.dtypes)["salary_gross"] == "boolean"
    rows = out.collect()
    assert [r.salary_gross for r in rows] == [True, False, None, True, False]
    assert [r.salary_from for r in rows] == [100000.0, 150000.0, None, 200000.0, 50000.0]


def test_city_tier(spark):
    df = spark.createDataFrame([("Москва", 1), ("Санкт-Петербург", 2), ("Казань", 3), ("Алматы", 4)],
                               "city string, vacancy_id bigint")
    out = features.add_city_tier(df)
    assert set(out.columns) == set(df.columns) | {"city_tier"}
    rows = out.orderBy("vacancy_id").collect()
    assert [r.vacancy_id for r in rows] == [1, 2, 3, 4]
    assert [r.city_tier for r in rows] == ["Moscow", "SPb", "Million+", "KZ/Other"]


def test_primary_role_priority(spark):
    df = spark.createDataFrame([(False, True, False, "Moscow"), (True, True, False, "SPb"), (False, False, True, "Kazan")],
                               "role_ml boolean, role_analyst boolean, role_backend boolean, city string")
    out = features.add_primary_role(df)
    assert set(out.columns) == set(df.columns) | {"primary_role"}
    assert [r.primary_role for r in out.collect()] == ["analyst", "ml", "backend"]


def _persona_frame(spark, rows):
    return spark.createDataFrame(rows, "primary_role string, grade string, skill_sql boolean, has_python boolean, "
                                       "skill_statistics boolean")


def test_skill_gap_marks_missing_and_existing(spark):
    df = _persona_frame(spark, [("data", "junior", True, True, False), ("data", "junior", True, False, True),
                                ("data", "junior", False, False, False)])
    p = personas.Persona("student", "", ["skill_sql", "skill_statistics"], "data", "junior")
    gap, res = personas.skill_gap_for_persona(df, p, min_share=0.2, top_n=None)
    g = {r.skill_name: r for r in gap.collect()}
    assert g["skill_sql"].persona_has is True and g["skill_sql"].gap is False
    assert g["has_python"].persona_has is False and g["has_python"].gap is True
    assert g["skill_statistics"].persona_has is True and g["skill_statistics"].gap is False
    assert res.relaxed_filters == []


def test_demand_profile_filters_and_sorts(spark):
    df = _persona_frame(spark, [("data", "junior", True, True, True), ("data", "junior", True, False, True),
                                ("other", "junior", True, False, False)])
    p = personas.Persona("student", "", [], "data", "junior")
    d = personas.build_skill_demand_profile(df, p, min_share=0.2).collect()
    assert [r.skill_name for r in d] == ["skill_sql", "skill_statistics", "has_python"]
    assert [r.market_share for r in d] == [1.0, 1.0, 0.5]
