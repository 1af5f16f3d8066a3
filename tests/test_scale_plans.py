"""Plans that must not grow faster than the input."""
import re

from pyspark.sql import functions as F

from hiresight.functions import exprs as X
from hiresight.operators import charts, personas, quality, quantiles, segments
from hiresight.plans import catalog


def _plan(df, part="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), part)().toString()


def test_feature_stage_writes_only_raw_rows_and_reads_the_columns_asked_for(spark, tmp_path, monkeypatch):
    # Features were all computed and written before any query
    written = []
    monkeypatch.setattr(catalog, "written_stage", lambda df, name: written.append(name) or df)
    monkeypatch.setattr(catalog, "_STAGES", {})
    d = str(tmp_path)
    tables = {
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(1, "INDIA", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(5, 1, 100.0)], "s_suppkey long, s_nationkey int, s_acctbal double"),
        "part": ([(9, "red gear", "Brand#1", "SMALL", 3)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "lineitem": ([(1, 9, 5, 1, 3.0, 10.0, 0.09, 0.01, "N", "O"), (2, 9, 5, 2, 9.0, 20.0, 0.0, 0.05, "N", "F"), (3, None, 5, 1, 9.0, 99.0, 0.0, 0.0, "N", "F")],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"),
    }
    for name, (rows, schema) in tables.items():
        t = spark.createDataFrame(rows, schema)
        if name == "lineitem":
            t = t.withColumn("l_shipdate", F.lit("2020-01-01").cast("timestamp_ntz"))
        t.write.parquet(f"{d}/{name}.parquet")
    got = catalog.REGISTRY["benefits_by_company"](spark, d)
    assert [(r.company, r.benefit_low_tax, r.n_vacancies) for r in got.collect()] == [("Brand#1", 0.5, 2)]
    assert written == ["raw"]
    read = "".join(re.findall(r"FileScan parquet \[(.*?)\]", _plan(got, "sparkPlan")))
    assert "p_brand#" in read and "p_type#" not in read and "l_extendedprice#" not in read, read
    v = catalog.V(spark, d).orderBy("vacancy_id").collect()
    assert [(r.tech_stack_size, r.primary_role, r.salary_mid_rub_capped) for r in v] == [(3, "gear", 10.1), (3, "gear", 19.9)]


def test_brackets_of_quantiles_are_broadcast(spark):
    # the rows were dealt out by group, a whole group to one task
    df = spark.range(20_000).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"))
    got = quantiles.grouped_quantiles(df, "v", [0.5], ["k"], ["m"])
    assert {r.k: r.m for r in got.collect()} == {0: 9999.0, 1: 10000.0}
    assert "SortMergeJoin" not in _plan(got, "sparkPlan") and "BroadcastHashJoin" in _plan(got, "sparkPlan")


def test_long_counts_appear_once_in_buckets(spark):
    # a count of flags was repeated in every bound of every bucket
    flags = [f"has_{i}" for i in range(12)]
    rows = [tuple(j < n if j else None for j in range(12)) for n in range(13)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} boolean" for c in flags)).withColumn("n", X.count_true(flags))
    for rule in (segments.stack_bucket, charts.stack_bucket_chart):
        out = df.select("n", rule(F.col("n")).alias("b")).where(F.col("b").isNotNull())
        assert len(re.findall(r"has_11#", _plan(out))) < 10
    n = [max(0, k - 1) for k in range(13)]
    assert [r.n for r in df.collect()] == n
    chart = [r.b for r in df.select(charts.stack_bucket_chart(F.col("n")).alias("b")).collect()]
    assert chart == ["0-2" if k <= 2 else "3-5" if k <= 5 else "6-10" if k <= 10 else "10+" for k in n]
    assert spark.range(1).select(charts.stack_bucket_chart(F.lit(None).cast("int")).alias("b"), segments.stack_bucket(F.lit(None).cast("int")).alias("c")).first() == ("0-2", None)


def test_filter_on_an_id_makes_no_combination_a_row(spark, monkeypatch):
    # rows were counted by every value of every filter column
    df = spark.range(500).select(F.col("id").alias("vacancy_id"), F.when(F.col("id") % 3 > 0, "a").alias("primary_role"), (F.col("id") % 2 == 0).alias("skill_x"))
    sizes, plain = [], personas.localized
    monkeypatch.setattr(personas, "localized", lambda t: sizes.append(t.count()) or plain(t))
    people = [personas.Persona("one", "", [], "a", constraints={"vacancy_id": 7}), personas.Persona("none", "", [], "b", constraints={"vacancy_id": [None, 9]})]
    got = {r.persona: (r.level, list(r.relaxed), r.market_n) for r in personas.batch_segments(df, people, min_market_n=1).collect()}
    assert got == {"one": (0, [], 1), "none": (2, ["vacancy_id", "primary_role"], 500)}
    assert max(sizes) < 20


def test_distinct_ids_are_counted_apart(spark):
    # the counts of markers were shuffled once an id
    df = spark.createDataFrame([(1, "n/a", 3, "RUB"), (1, "x", None, None), (None, None, 4, "USD")], "vacancy_id int, t string, vacancy_age_days int, currency string")
    out = quality.validate_clean(df, markers=["n/a"])
    r = out.first()
    assert (r.rows, r.markers_left, r.age_present, r.duplicate_ids) == (3, 1, True, 2)
    assert not any("distinct" in line and "sum(" in line for line in _plan(out).splitlines())
