"""ST1: incremental (daily-delta) intake: keep the latest row per id, or the first
seen.

*Latest.*  New files are read by the Structured Streaming file source.  The stream
itself keeps no state: each micro-batch is reduced to its latest row per id and
merged into a table whose rows lie in buckets by a hash of the id.  Only buckets
that the batch touches are read and written again, as a new version; a commit
record then names the buckets written.  The current table is each bucket's last
committed version, so a half-written batch is never seen, and a batch that is run
again starts from the versions before it and replaces its own.  ``forget_old``
deletes versions that no reader needs.

*First seen.*  ``dropDuplicatesWithinWatermark`` keeps an id in the state store only
until the watermark passes its time plus the delay, so the state is bounded by the
ids of that span, not by the history.

``availableNow`` processes what is there and stops, so a daily job always ends; the
stream's checkpoint lets the next run go on where this one stopped.
"""
from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.cleaning import deduplicate
from ..session import ensure_checkpoint_dir, shared_path

BUCKETS = 16
COMMIT = "epoch long, bucket int, rows long, buckets int"


def _stream(spark: SparkSession, source_dir: str, schema: T.StructType, ts_col: str, glob: str) -> DataFrame:
    # as a pattern, the path may be a folder of part files or a single file
    path = re.sub(r"([^/\[\]*?{}])/*$", r"[\1]", source_dir)
    stream = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(path)
    if isinstance(schema[ts_col].dataType, T.TimestampNTZType):
        stream = stream.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return stream


def commits(spark: SparkSession, base: str) -> list:
    """The commit records: a row for each bucket of each committed batch."""
    fs, p = shared_path(spark, f"{base}/commits")
    if not fs.exists(p):
        return []
    done = [str(s.getPath().getName()) for s in fs.listStatus(p) if fs.exists(shared_path(spark, f"{s.getPath()}/_SUCCESS")[1])]
    if not done:
        return []
    return spark.read.schema(COMMIT).json([f"{base}/commits/{d}" for d in done]).collect()


def versions(spark: SparkSession, base: str, before: int | None = None) -> dict[int, tuple[int, int]]:
    """bucket -> (epoch, rows) of its last committed version (before an epoch)."""
    out: dict[int, tuple[int, int]] = {}
    for r in commits(spark, base):
        if before is None or r.epoch < before:
            out[r.bucket] = max(out.get(r.bucket, (-1, 0)), (r.epoch, r.rows))
    return out


def _read(spark: SparkSession, base: str, schema: T.StructType, held: dict[int, int]) -> DataFrame:
    """The rows of these versions of buckets."""
    paths = [f"{base}/rows/epoch={e}/_bucket={b}" for b, e in sorted(held.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge_batch(batch: DataFrame, epoch: int, base: str, id_col: str, ts_col: str, tiebreak: list[str], buckets: int = BUCKETS) -> None:
    """Merges a batch into the table at ``base``; of rows that tie, a later batch's wins."""
    spark = batch.sparkSession
    known = next((r.buckets for r in commits(spark, base)), buckets)
    bucket = F.pmod(F.xxhash64(F.lit(7), id_col), F.lit(known)).cast("int")
    new = deduplicate(batch, id_col, ts_col, tiebreak).withColumn("_bucket", bucket)
    path = f"{base}/batches/epoch={epoch}"
    new.write.mode("overwrite").parquet(path)                          # the stream is read once
    new = spark.read.schema(new.schema).parquet(path)
    touched = [r["_bucket"] for r in new.select("_bucket").distinct().collect()]  # at most the number of buckets
    held = {b: e for b, (e, _) in versions(spark, base, epoch).items() if b in set(touched)}
    old = _read(spark, base, batch.schema, held).withColumns({"_bucket": bucket, "_new": F.lit(0)})
    both = old.unionByName(new.withColumn("_new", F.lit(1)))
    merged = deduplicate(both, id_col, ts_col, [*tiebreak, "_new"]).drop("_new")
    merged.repartition(max(1, len(touched)), "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{base}/rows/epoch={epoch}")
    sizes = spark.read.parquet(f"{base}/rows/epoch={epoch}").groupBy("_bucket").count().collect() if touched else []
    record = [(epoch, r["_bucket"], r["count"], known) for r in sizes]
    spark.createDataFrame(record, COMMIT).coalesce(1).write.mode("overwrite").json(f"{base}/commits/epoch={epoch}")


def run_intake(spark: SparkSession, source_dir: str, schema: T.StructType, id_col: str, ts_col: str,
               tiebreak: list[str] | None = None, glob: str = "*.parquet", out_dir: str | None = None, buckets: int = BUCKETS) -> str:
    """Process all files now in ``source_dir`` (a folder, or one file) and return the
    table's folder.  Called again with the same ``out_dir`` it goes on where the last
    call stopped."""
    base = out_dir or f"{ensure_checkpoint_dir(spark).rstrip('/')}/intake-{uuid.uuid4().hex}"
    stream = _stream(spark, source_dir, schema, ts_col, glob)
    q = (stream.writeStream.foreachBatch(lambda batch, epoch: merge_batch(batch, epoch, base, id_col, ts_col, list(tiebreak or []), buckets))
               .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return base


def current_table(spark: SparkSession, base: str) -> DataFrame:
    """The latest row per id: the last committed version of every bucket."""
    held = {b: e for b, (e, _) in versions(spark, base).items()}
    if not held:
        raise FileNotFoundError(f"no batch has been committed at {base}")
    part = spark.read.parquet(f"{base}/rows/epoch={max(held.values())}")
    return _read(spark, base, T.StructType([f for f in part.schema.fields if f.name != "_bucket"]), held)


def forget_old(spark: SparkSession, base: str) -> int:
    """Deletes the versions of buckets that a later committed one replaces, and the
    copies of merged batches; gives the number of folders deleted."""
    done = commits(spark, base)
    held = {b: e for b, (e, _) in versions(spark, base).items()}
    old = [f"{base}/rows/epoch={r.epoch}/_bucket={r.bucket}" for r in done if held[r.bucket] != r.epoch]
    old += [f"{base}/batches/epoch={e}" for e in sorted({r.epoch for r in done})]
    return sum(bool(fs.exists(p) and fs.delete(p, True)) for fs, p in (shared_path(spark, path) for path in old))


def first_seen_stream(stream: DataFrame, id_col: str, ts_col: str, delay: str = "1 day") -> DataFrame:
    """Keeps the first copy of each id seen within the watermark delay; later copies
    within it, and rows older than the watermark, go."""
    return stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([id_col])


def run_first_seen(spark: SparkSession, source_dir: str, schema: T.StructType, id_col: str, ts_col: str, delay: str = "1 day",
                   glob: str = "*.parquet", out_dir: str | None = None, files_a_batch: int | None = None) -> tuple[str, StreamingQuery]:
    """Appends the rows first seen among the files now in ``source_dir`` to the table at the
    folder returned; the query tells the state's size (``stateOperators``)."""
    base = out_dir or f"{ensure_checkpoint_dir(spark).rstrip('/')}/first-seen-{uuid.uuid4().hex}"
    stream = _stream(spark, source_dir, schema, ts_col, glob) if files_a_batch is None else \
        spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_a_batch).parquet(source_dir)
    q = (first_seen_stream(stream, id_col, ts_col, delay).writeStream.outputMode("append")
         .foreachBatch(lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{base}/rows/epoch={epoch}"))
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return f"{base}/rows", q
