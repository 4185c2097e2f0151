"""Parquet sources.  Column pruning and filter pushdown are left to Catalyst:
callers select what they need and the scan's ReadSchema shrinks to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=("events", "orders", "lineitem",
                                                             "part", "customer")) -> None:
    """Register raw tables as temp views (lazy; nothing is read here)."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
