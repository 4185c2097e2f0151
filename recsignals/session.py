"""Session construction and cluster-safe materialisation helpers."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings the operators rely on.  UTC makes ``timestamp`` and
# ``timestamp_ntz`` carry the same wall clock, so micros arithmetic is exact.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # Shuffle files go when the job that made them ends; else they stay until the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "recsignals", extra: dict | None = None) -> SparkSession:
    """Return a session with the settings above.

    On a cluster ``master`` stays None (the launcher decides) and
    ``spark.checkpoint.dir`` comes from the cluster config; only when it is
    unset (local tests) a local folder is used.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: the cluster's ``spark.checkpoint.dir``.

    Only a ``local`` master may leave it unset (tests); it then gets a new
    temporary folder.  Elsewhere an unset folder is an error, since executors
    would not share a machine-local one."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="recsignals-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


_RUN = f"run-{uuid.uuid4().hex}"


def run_folder(spark: SparkSession) -> str:
    """This driver's own folder below the shared one; removed when the driver ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{_RUN}"
    if path not in _OWNED:
        _OWNED.add(path)
        atexit.register(drop_path, spark, path)
    return path


_OWNED: set[str] = set()


#: Bytes a task should read from files or, compressed, from a shuffle; and of stored tables per shuffle partition.
TASK_BYTES, INPUT_BYTES_PER_PARTITION = 16 << 20, 4 << 20


def bound_tasks(spark: SparkSession, paths: list[str]) -> None:
    """Keep a task's share bounded as the input grows: small splits, small merged shuffle partitions, and as many of
    them before merging as the tables at ``paths`` need (never fewer than the session's own number). Shuffle files of
    a job are deleted at its end, so that the disk holds those of one job at a time."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    size = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        size += p.getFileSystem(conf).getContentSummary(p).getLength()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // INPUT_BYTES_PER_PARTITION))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TASK_BYTES))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(2 * TASK_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a staged table through Spark's own file system layer."""
    sc = spark.sparkContext
    if sc._jsc is None or sc._jsc.sc().isStopped():
        return
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def stage(df: DataFrame, name: str | None = None) -> DataFrame:
    """Alias of :func:`materialize` used inside plans before a fan-out."""
    return materialize(df, name)


def write_stage(df: DataFrame, name: str | None = None) -> str:
    """Write ``df`` as parquet under the shared checkpoint folder; return the path."""
    path = f"{run_folder(df.sparkSession)}/{name or 'stage'}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def write_buckets(df: DataFrame, by: list[str], buckets: int, name: str) -> str:
    """Write ``df``, which lies in ``buckets`` partitions by ``by``, as a table in that many buckets below the run folder; return
    the table's name. Joins and windows by ``by`` read it without an exchange."""
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, *by).format("parquet").option("path", f"{run_folder(spark)}/{table}").option("compression", "zstd").saveAsTable(table)
    return table


def drop_buckets(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE {table}")
    drop_path(spark, f"{run_folder(spark)}/{table}")


def materialize(df: DataFrame, name: str | None = None) -> DataFrame:
    """Cut lineage by writing parquet under the shared checkpoint folder and
    reading it back.  Survives executor loss (unlike local checkpoints)."""
    return df.sparkSession.read.parquet(write_stage(df, name))
