"""Sinks: a named table (S6) and CSV output (S7), both written by Spark as folders of part files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Materialise a relation as Parquet and return it read back."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header in each part; nulls are empty, empty strings quoted. No merge into one file."""
    df.write.mode("overwrite").option("header", "true").option("emptyValue", '""').csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").csv(path)
