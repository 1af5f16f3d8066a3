"""Spark session helpers.

Library code never creates or configures a session on its own; these helpers are
for scripts, tests and the benchmark.  On a cluster the session (and its
``spark.checkpoint.dir``) comes from the platform; ``ensure_checkpoint_dir`` only
fills it in when it is unset, as happens in local tests.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", app: str = "hiresight") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a scratch one only if unset."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; a cluster must name a shared folder for it")
    path = tempfile.mkdtemp(prefix="hiresight-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def shared_path(spark: SparkSession, path: str):
    """(file system, path) of a path in any store that Spark opens."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def reliable_checkpoint(df):
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Used where later steps must see exactly the same rows twice (e.g. row ids
    from ``monotonically_increasing_id``), which a recomputation after an
    executor loss would not guarantee."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written_stage(df, name: str):
    """Write ``df`` as a stage table (Parquet) in the shared checkpoint folder and
    read it back, so that later queries read only the columns they need."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
