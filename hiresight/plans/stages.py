"""Q-1 / Q-3: the stage chain raw → clean → features → market view.

Canonical order: parse dates → deduplicate → missingness → salary measure
(``legacy_order=True`` runs missingness → dates → salary → dedup instead, so the
clip quantiles are taken before deduplication).  Stage tables are written
only when an output folder is given; otherwise everything stays one lazy plan
with its few bounded actions (null shares, boolean detection, clip edges).

With an output folder the chain can be restarted.  A stage is finished when its
commit record is there; the record names the data written and the token of what it was
made from (options, code version and the input's token).  A finished stage whose token
still holds is reused; anything else (killed half-way, absent, made from another input) is
made anew, into a folder of its own, so a half-written table is never read, and so are the
stages after it.
"""
from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning as CL
from ..operators import features as FE
from ..operators.market import build_market_view
from ..session import shared_path
from ..sources.raw import save_stage

#: To be raised when a stage's rules change, so that tables of older rules are made anew.
VERSION = 1


@dataclass
class StageResult:
    clean: DataFrame
    features: DataFrame
    market: DataFrame
    report: dict = field(default_factory=dict)
    reused: list[str] = field(default_factory=list)


def table_token(df: DataFrame) -> str:
    """Changes with the table's columns and rows (not with their order); one pass."""
    row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)"))).first()
    return hashlib.sha256(json.dumps([df.schema.json(), row[0], str(row[1])]).encode()).hexdigest()[:32]


def _record(spark: SparkSession, out_dir: str, name: str) -> dict | None:
    fs, path = shared_path(spark, f"{out_dir}/_commits/{name}/_SUCCESS")
    if not fs.exists(path):
        return None
    lines = spark.read.text(f"{out_dir}/_commits/{name}").collect()
    return json.loads(lines[0].value) if lines else None


def committed(spark: SparkSession, out_dir: str, name: str, token: str, make: Callable[[], tuple[DataFrame, dict]]) -> tuple[DataFrame, dict, bool]:
    """A stage's table, its report, and whether it was reused: made by ``make`` and written
    unless a committed one of the same token is there."""
    done = _record(spark, out_dir, name)
    if done and done["token"] == token and shared_path(spark, done["path"])[0].exists(shared_path(spark, done["path"])[1]):
        return spark.read.parquet(done["path"]), done["report"], True
    df, report = make()
    path = f"{out_dir}/{name}/{uuid.uuid4().hex}"
    save_stage(df, path, "parquet")
    record = json.dumps({"token": token, "path": path, "report": report})
    spark.createDataFrame([(record,)], "value string").coalesce(1).write.mode("overwrite").text(f"{out_dir}/_commits/{name}")
    return spark.read.parquet(path), report, False


def run_stages(raw: DataFrame, out_dir: str | None = None, drop_threshold: float | None = 0.95,
               legacy_order: bool = False, id_col: str = "vacancy_id", raw_token: str | None = None) -> StageResult:
    """``raw_token`` tells one version of the raw table from another (a delta's name or
    date); without it the table is hashed in one pass."""
    def clean() -> tuple[DataFrame, dict]:
        if legacy_order:
            cleaned = CL.handle_missingness(raw, drop_threshold)
            return CL.deduplicate(CL.salary_prepare(CL.parse_dates(cleaned.df)), id_col), cleaned.report
        cleaned = CL.handle_missingness(CL.deduplicate(CL.parse_dates(raw), id_col), drop_threshold)
        return CL.salary_prepare(cleaned.df), cleaned.report

    if not out_dir:
        df, report = clean()
        feats = FE.assemble_features(df)
        return StageResult(df, feats, build_market_view(feats), report)
    spark = raw.sparkSession
    token = json.dumps([VERSION, raw_token or table_token(raw), drop_threshold, legacy_order, id_col])
    df, report, old_clean = committed(spark, out_dir, "clean", token, clean)
    source = _record(spark, out_dir, "clean")["path"]          # a table made anew is another input
    feats, _, old_feats = committed(spark, out_dir, "features", json.dumps([VERSION, source]), lambda: (FE.assemble_features(df), {}))
    source = _record(spark, out_dir, "features")["path"]
    market, _, old_market = committed(spark, out_dir, "market_view", json.dumps([VERSION, source]), lambda: (build_market_view(feats), {}))
    reused = [n for n, old in (("clean", old_clean), ("features", old_feats), ("market_view", old_market)) if old]
    return StageResult(df, feats, market, report, reused)


def requirement_stats_filled(df: DataFrame, flags: list[str], which: str = "english", **options) -> DataFrame:
    """Q-3: NULL flags forced to false, then the English or education stats."""
    from ..operators.segments import education_requirement_stats, english_requirement_stats
    present = [c for c in flags if c in df.columns]
    filled = df.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in present}) if present else df
    return (english_requirement_stats if which == "english" else education_requirement_stats)(filled, **options)
