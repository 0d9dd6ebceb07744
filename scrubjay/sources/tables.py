"""Catalog-style access to the Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Scan one table; filters and projections applied later reach the Parquet reader."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
