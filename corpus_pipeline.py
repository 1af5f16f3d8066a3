"""The corpus pipeline: five stages over ``documents``, each written as Parquet
to the shared folder and read back as the next one's input.

1. quality classifier: documents it rejects go;
2. language ID: documents it rejects go;
3. n-gram Jaccard join: one document of each group of near copies stays;
4. benchmark decontamination: documents that hold a benchmark window go;
5. mixing sources to target weights: a row for each time the mix takes a document.

All stages but the last return the columns of ``documents``.  Every stage trains,
counts and decides on what its predecessor kept.  An empty input gives an empty
result at every stage.
"""
from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from hiresight.llm import decontam, langid, mixing, nearjoin, quality  # noqa: E402
from hiresight.llm.frames import ship_package, table, written  # noqa: E402

#: The near-copy stage: words in a shingle, and the least Jaccard similarity in percent.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return langid.keep_identified(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return nearjoin.keep_one_each(docs, k=NEAR_WORDS, percent=NEAR_PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("near_copies", near_copies),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
]

#: Trained stages can't be said in SQL; tests hold the pipeline against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
