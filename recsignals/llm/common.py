"""Helpers that the training-data operators share: staged tables, checked broadcasts, row keys."""

from __future__ import annotations

import atexit
import math
import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recsignals.session import materialize

#: Stands for a null id while rows are in flight inside an operator.
NULL_ID = -(2**63)
#: Largest table (estimated bytes) that is sent whole to every executor.
BROADCAST_BYTES = 64 << 20


#: Rows of one Arrow batch between Spark and Python where the session has Spark's default: texts are long rows.
BATCH_ROWS = 1_000
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Prepare a session: texts go to Python in small batches, and executors get this package as ``--py-files`` would."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    if spark.sparkContext.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    folder = tempfile.mkdtemp(prefix="recsignals-")  # the driver serves the archive from here until it ends
    atexit.register(shutil.rmtree, folder, True)
    copy = os.path.join(folder, "package")
    shutil.copytree(os.path.join(root, "recsignals"), os.path.join(copy, "recsignals"), ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "recsignals"), "zip", copy))
    _shipped.add(spark.sparkContext.applicationId)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, lost executors cost no recomputation upstream."""
    ship_package(df.sparkSession)
    return materialize(df, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keyed(docs: DataFrame, id_col: str, text_col: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Only what the operators need: ``kid`` (id, null as NULL_ID), ``th`` (text hash) and ``text``.

    ``(kid, th)`` names a text of a row: rows that repeat both are interchangeable.
    """
    ship_package(docs.sparkSession)
    t = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NULL_ID)).alias("kid"), F.xxhash64(t).alias("th"), t.alias("text"), *[docs[c] for c in extra])


def id_back(col: str = "kid") -> Column:
    return F.when(F.col(col) != NULL_ID, F.col(col))


def small_side(staged: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a staged table if its counted size allows it; else leave the join to a shuffle."""
    return F.broadcast(staged) if staged.count() * row_bytes <= limit else staged


def buckets(units: float, per_bucket: float, least: int = 12) -> int:
    """How many hash buckets keep each near ``per_bucket`` units of work; grows with the input."""
    return max(least, math.ceil(units / per_bucket))


def few(df: DataFrame, rows: int, per_task: int = 50_000) -> DataFrame:
    """A table of about ``rows`` rows in no more tasks than these fill, whatever the number of shuffle partitions; without a further exchange."""
    return df.coalesce(buckets(rows, per_task))


def text_volume(docs: DataFrame, text_col: str) -> int:
    """Bytes of text, from one pass over that column."""
    return docs.agg(F.sum(F.octet_length(docs[text_col]))).first()[0] or 0


def without(docs: DataFrame, rejected: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs less the rows named by (id, ``th``) in ``rejected``; all columns stay."""
    gone = stage(rejected.select(F.col(id_col).cast("long").alias("__id"), F.col("th").alias("__th")).distinct(), "rejected")
    gone = small_side(gone, 32)
    same = docs[id_col].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))) == F.col("__th"))
    return docs.join(gone, same, "left_anti")
