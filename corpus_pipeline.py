"""The training-data pipeline over ``documents``: each stage calls one operator and writes what it keeps as Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scrubjay.llm import decontaminate, language, minhash, packing, toxicity
from scrubjay.llm.common import ship
from scrubjay.llm.queries import tokenizer_path
from scrubjay.session import scratch_path
from scrubjay.sources.tables import load

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more for toxicity go."""
    ship(spark)
    return toxicity.drop_toxic(docs, load(spark, sf_dir, "labels"))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language go."""
    ship(spark)
    return language.drop_unidentified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    ship(spark)
    return minhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    ship(spark)
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic), ("language", keep_identified), ("near_dedup", near_dedup),
    ("decontaminate", drop_contaminated), ("pack", pack)]

#: Learned models and a tokenizer decide the rows, so SQL cannot express them; tests compare with brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage's output is written below the shared checkpoint folder and reread."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
