"""Keep-latest by bucket versions, first seen within the watermark, deduplication."""
import pytest
from pyspark.sql import functions as F

from hiresight.operators.cleaning import deduplicate
from hiresight.streaming import intake as I

ROWS = "id long, ts string, v string"


def frame(spark, rows):
    return spark.createDataFrame(rows, ROWS).selectExpr("id", "timestamp(ts) ts", "v")


def test_intake_goes_on_where_it_stopped(spark, tmp_path):
    src, out = str(tmp_path / "t.parquet"), str(tmp_path / "out")
    frame(spark, [(1, "2024-01-01", "a"), (2, "2024-01-02", "b"), (None, "2024-01-02", "n")]).write.parquet(src)
    schema = spark.read.parquet(src).schema
    with pytest.raises(FileNotFoundError):
        I.current_table(spark, out)
    base = I.run_intake(spark, src, schema, "id", "ts", out_dir=out, buckets=4)
    frame(spark, [(1, "2024-01-03", "c"), (2, "2024-01-01", "late"), (3, "2024-01-01", "d")]).write.mode("append").parquet(src)
    assert I.run_intake(spark, src, schema, "id", "ts", out_dir=out, buckets=4) == base
    frame(spark, [(3, "2024-01-01", "tie: the later batch wins")]).write.mode("append").parquet(src)
    I.run_intake(spark, src, schema, "id", "ts", out_dir=out, buckets=4)
    want = {1: "c", 2: "b", 3: "tie: the later batch wins", None: "n"}
    assert {r.id: r.v for r in I.current_table(spark, base).collect()} == want
    assert sum(n for _, n in I.versions(spark, base).values()) == len(want)       # what is kept is a row an id
    assert I.run_intake(spark, src, schema, "id", "ts", out_dir=out) == base       # nothing new
    assert I.forget_old(spark, base) > 0 and {r.id: r.v for r in I.current_table(spark, base).collect()} == want


def test_a_batch_run_again_and_a_half_written_one(spark, tmp_path):
    base = str(tmp_path / "out")
    merge = lambda rows, epoch: I.merge_batch(frame(spark, rows), epoch, base, "id", "ts", [], 2)
    merge([(1, "2024-01-01", "a"), (2, "2024-01-01", "b")], 0)
    merge([(1, "2024-01-02", "c"), (1, "2024-01-02", "c")], 1)
    for _ in range(2):
        assert {r.id: r.v for r in I.current_table(spark, base).collect()} == {1: "c", 2: "b"}
        merge([(1, "2024-01-02", "c")], 1)                                         # again, e.g. after a lost driver
    frame(spark, [(1, "2025-01-01", "lost")]).withColumn("_bucket", F.lit(0)).write.partitionBy("_bucket").parquet(f"{base}/rows/epoch=2")
    assert {r.id: r.v for r in I.current_table(spark, base).collect()} == {1: "c", 2: "b"}
    assert {r.bucket for r in I.commits(spark, base) if r.epoch == 1} == {next(b for b, (e, _) in I.versions(spark, base).items() if e == 1)}


def test_first_seen_has_bounded_state(spark, tmp_path):
    src, out = str(tmp_path / "t"), str(tmp_path / "out")
    states = []
    for day in range(1, 6):
        frame(spark, [(i, f"2024-01-0{day} 00:00:00", "x") for i in (day, day, 100)] + [(7, "2023-01-01", "late")] * (day > 2)) \
            .coalesce(1).write.mode("append").parquet(src)
        rows, q = I.run_first_seen(spark, src, spark.read.parquet(src).schema, "id", "ts", "36 hours", out_dir=out)
        states.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = spark.read.parquet(rows).groupBy("id").count().collect()
    assert {r.id: r["count"] for r in got if r.id < 100} == {d: 1 for d in range(1, 6)}     # late rows go
    assert max(states) <= 5 and states[-1] < 6                                              # not one for each id ever seen


def test_deduplicate_fetches_whole_rows_once(spark):
    rows = [(1, 5, "a", "x" * 50), (1, 7, "b", "y"), (1, 7, "b", "y"), (2, None, "c", None), (2, 1, None, "z"), (None, 1, "n", "m"), (None, 2, "n", "o"), (3, None, None, None)]
    df = spark.createDataFrame(rows, "id int, ts int, k string, wide string")
    out = deduplicate(df, "id", "ts", ["k"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, 7, "b", "y"), (2, 1, None, "z"), (None, 2, "n", "o"), (3, None, None, None)], key=str)
    assert out.columns == df.columns and deduplicate(df.limit(0), "id", "ts").count() == 0
    big = spark.range(1000).selectExpr("id % 10 id", "id ts", "cast(id as string) wide")
    assert {r.id: r.ts for r in deduplicate(big, "id", "ts").collect()} == {i: 990 + i for i in range(10)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    reduced = next(line for line in plan.splitlines() if "Aggregate" in line and "max(" in line)
    assert "wide" not in reduced.split("max(")[1].split(")")[0]                             # only ids and order columns are reduced
