"""Small DataFrame helpers shared by the operators."""
from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_shipped: set[str] = set()


def fresh(columns: list[str], name: str) -> str:
    """``name``, or ``name`` with underscores appended until no column (in any
    case) is called that."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_remainder(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null id: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(mod)


def hash_share(columns: list[Column], share: float | Column, seed: int = 1) -> Column:
    """True for about ``share`` of the rows, the same rows on every run."""
    u = F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1_000_000_007)) / F.lit(1_000_000_007.0)
    return u < share


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package (once per application), unless they find it
    on PYTHONPATH."""
    sc, package = spark.sparkContext, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    if sc.applicationId in _shipped or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    name = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, root))
    sc.addPyFile(name)
    _shipped.add(sc.applicationId)


def new_folder(spark: SparkSession, kind: str) -> str:
    """A folder of its own in the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the
    lineage, and later steps read only the columns they need."""
    path = f"{new_folder(df.sparkSession, kind)}/rows.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
