"""CSV files read in several byte ranges equal the single-task read."""
import csv
import io
import random

import pytest

from hiresight.sources.csvsplit import read_csv
from hiresight.sources.raw import load_raw, read_stage, save_stage


def text_of(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


@pytest.fixture()
def small_ranges(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "64"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


def rows_of(n, seed):
    r = random.Random(seed)
    words = ["текст", 'he said "no"', "line\nbreak", 'a,b', '""', "\n\n", "ж" * 30, '"\n"', ""]
    return [[str(seed * 1000 + i), "".join(r.choice(words) for _ in range(r.randrange(12))), r.choice(["", "x", 'quo"te']),
             ("long " * 900 + "\n") * (3 if i % 40 == 7 else 0)] for i in range(n)]


def test_ranges_equal_the_whole_read(spark, tmp_path, small_ranges):
    rows = rows_of(150, 1)
    (tmp_path / "a.csv").write_text(text_of([["id", "text", "note", "long"], *rows]), encoding="utf-8", newline="")
    got = read_csv(spark, str(tmp_path / "a.csv"))
    assert got.columns == ["id", "text", "note", "long"] and spark.read.text(str(tmp_path / "a.csv")).rdd.getNumPartitions() > 10
    held = {r.id: tuple(v or "" for v in r) for r in got.collect()}
    assert held == {x[0]: tuple(x) for x in rows} and got.count() == len(rows)
    one = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "a.csv"))
    assert {r.id: tuple(v or "" for v in r) for r in one.collect()} == held


def test_files_with_other_column_orders(spark, tmp_path, small_ranges):
    a, b = rows_of(40, 1), rows_of(60, 2)
    (tmp_path / "a.csv").write_text("﻿" + text_of([["id", "text", "note", "long"], *a], "\r\n"), encoding="utf-8", newline="")
    (tmp_path / "b.csv").write_text(text_of([["long", "extra", "id", "text"], *([x[3], "e", x[0], x[1]] for x in b)]) + "\n\n", encoding="utf-8", newline="")
    (tmp_path / "c.csv").write_text("id,text\n", encoding="utf-8")
    (tmp_path / "d.csv").write_text("", encoding="utf-8")
    got = read_csv(spark, str(tmp_path))
    assert set(got.columns) == {"id", "text", "note", "long", "extra"}
    held = {r.id: tuple(r[c] or "" for c in ("id", "text", "note", "long", "extra")) for r in got.collect()}
    assert held == {**{x[0]: (*x, "") for x in a}, **{x[0]: (x[0], x[1], "", x[3], "e") for x in b}} and got.count() == 100


def test_raw_and_stage(spark, tmp_path, small_ranges):
    (tmp_path / "raw.csv").write_text('salary_from,title,vacancy_id,description,salary_gross\n100000,A,1,"line one\nline ""two""",yes\nabc,B,2,plain,unknown\n', encoding="utf-8")
    df = load_raw(spark, str(tmp_path / "raw.csv"))
    rows = df.select("vacancy_id", "description", "salary_from", "salary_gross").orderBy("vacancy_id").collect()
    assert [tuple(r) for r in rows] == [("1", 'line one\nline "two"', 100000, True), ("2", "plain", None, None)] and len(df.columns) == 151
    save_stage(df.select("vacancy_id", "description"), str(tmp_path / "stage.csv"))
    assert {tuple(r) for r in read_stage(spark, str(tmp_path / "stage.csv")).collect()} == {("1", 'line one\nline "two"'), ("2", "plain")}
