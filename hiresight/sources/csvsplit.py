"""Quoted CSV read in splits: a record may span lines, and a file many tasks.

Spark's text source gives the lines of each byte range.  Whether a line break ends a
record depends on the quotes before it, which a task that starts inside a file can't
see.  So a first pass counts the quotes of each range (an aggregate: one row a range,
no more than the driver holds to plan the read); their running sum per file tells
each range whether it starts inside quotes.  In the second pass each task puts its
lines together to records, without a shuffle; only the pieces at the borders of
ranges, at most two a range, are grouped.  Records are then parsed natively.

Quotes are doubled inside quoted fields and occur nowhere else, as CSV writers make
them; a lone carriage return doesn't end a record.  Every file has its own header
(one line): columns are found by name, in any order, and absent ones are null.  Blank
lines are skipped; a last record whose quotes are never closed is kept as it is.  An
empty file, or one with a header alone, gives no rows.
"""
from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = "file string, block bigint, part int, record string"
#: part: a whole record, the end of one begun in an earlier range, the begin of one that goes on.
WHOLE, HEAD, TAIL = 0, 1, 2


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _assemble(starts_inside: dict[tuple[str, int], bool]):
    """A task: lines of ranges in order -> records and border pieces."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, inside, head, header, out = None, [], False, False, False, []

        def close() -> None:
            if held:
                out.append((*now, TAIL if not head else HEAD, "\n".join(held)))
                held.clear()

        def send() -> pa.RecordBatch:
            rows = list(zip(*out)) or [[], [], [], []]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int32()),
                                               pa.array(rows[3], pa.string())], names=["file", "block", "part", "record"])

        for batch in batches:
            for line, file, block in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, block) != now:
                    close()
                    now = (file, block)
                    if now not in starts_inside:
                        raise RuntimeError("the file's ranges have changed since they were counted; read it again")
                    inside = head = starts_inside[now]
                    header = block == 0
                held.append(line)
                inside ^= line.count('"') % 2 == 1
                if not inside:
                    text = "\n".join(held)
                    held.clear()
                    if header:
                        header = False
                    elif head or text.strip():
                        out.append((*now, HEAD if head else WHOLE, text))
                    head = False
            if out:
                yield send()
        close()
        if out:
            yield send()

    return task


def read_csv(spark: SparkSession, path) -> DataFrame:
    """All columns that occur in the headers, as text, in order of first occurrence."""
    lines = _lines(spark, path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    ranges = lines.withColumn("_at", F.monotonically_increasing_id()).groupBy("file", "block").agg(
        F.sum(quotes).alias("quotes"), F.min_by("value", F.when(F.col("block") == 0, F.col("_at"))).alias("header")).collect()
    starts_inside, headers, seen = {}, {}, {}
    for r in sorted(ranges, key=lambda r: (r.file, r.block)):
        starts_inside[r.file, r.block] = seen.get(r.file, 0) % 2 == 1
        seen[r.file] = seen.get(r.file, 0) + r.quotes
        if r.block == 0:
            headers.setdefault((r.header or "").lstrip("﻿").rstrip("\r"), []).append(r.file)
    kinds = [(h, next(csv.reader([h]))) for h in headers if h.strip()]
    columns = list(dict.fromkeys(c for _, names in kinds for c in names))
    if not columns:
        return spark.createDataFrame([], T.StructType([]))

    records = lines.mapInArrow(_assemble(starts_inside), RECORD)
    border = records.where(F.col("part") != WHOLE)
    group = F.sum(F.when(F.col("part") == TAIL, 1).otherwise(0)).over(Window.partitionBy("file").orderBy("block", "part"))
    joined = border.withColumn("group", group).groupBy("file", "group").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "part", "record"))), lambda p: p["record"]), "\n").alias("record"))
    texts = records.where(F.col("part") == WHOLE).select("file", "record").unionByName(joined.select("file", "record").where(F.trim("record") != ""))
    options = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1", "maxColumns": "100000"}
    number = F.lit(0)
    if len(kinds) > 1:
        kind_of = {f: i for i, (h, _) in enumerate(kinds) for f in headers[h]}
        small = spark.createDataFrame(list(kind_of.items()), "file string, _kind int")
        texts, number = texts.join(F.broadcast(small), "file") if len(kind_of) <= 100_000 else texts.join(small, "file"), F.col("_kind")
    record = F.regexp_replace("record", r"\r$", "")
    parsed = [F.when(number == i, F.from_csv(record, ", ".join(f"c{j} string" for j in range(len(names))), options)) for i, (_, names) in enumerate(kinds)]
    texts = texts.select(*[p.alias(f"_p{i}") for i, p in enumerate(parsed)])
    return texts.select(*[F.coalesce(*[F.col(f"_p{i}.c{names.index(c)}") for i, (_, names) in enumerate(kinds) if c in names]).alias(c) for c in columns])
