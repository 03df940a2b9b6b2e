"""A corpus pipeline: documents through a chain of the ``llm`` operators, each stage written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm.contamination import decontaminate
from newsflow.llm.lines import drop_boilerplate
from newsflow.llm.mixing import mixture
from newsflow.llm.neardup import near_dedup
from newsflow.llm.quality import quality_filter
from newsflow.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their sources; none goes. ``n_chars`` follows the text."""
    clean = drop_boilerplate(docs)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else clean


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have no benchmark item in them."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per copy taken of a document, with its shard and its position there."""
    return mixture(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark),
    ("mixing", mix),
]

# Hashes, models and alignments have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
