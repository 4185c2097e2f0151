"""A stored cumulative history that many candidate tables read and new days are appended to.

Two bucketed tables, both partitioned by ``batch`` (the earliest time of the rows an append brought):

* *rows*: one row per (keys, time) with the state of all rows up to and including that time, bucketed by
  (keys, time bucket) and sorted by time inside it;
* *last*: the last state of each (keys, time bucket), bucketed by keys. It gives the values carried into a later
  time bucket, and the state that an append starts from, so no append reads the log of earlier days again.

:meth:`HistoryStore.append` reduces the new rows to one per (keys, time), runs the states over them and adds the state
each key had before. An append that is run again overwrites its own batch and starts from the batches before it, so one
that broke off half-way is simply repeated. Rows at or before the end of an earlier batch are refused: later rows
already hold states without them.

:meth:`HistoryStore.attach` is an as-of join like :func:`recsignals.operators.asof.asof_join` that moves the candidates
only: probes are sent to the partitions of the stored buckets, the stored rows are read where they are. A key with a
large share of the log is cut into time buckets, of which each holds at most one row per distinct time.

States combine exactly for integers, decimals, counts, minima and maxima; sums of doubles depend on the order of adding
as everywhere. Rows with a null key or time are left out, and match nothing. Null measures are skipped.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recsignals.functions.expr import micros
from recsignals.operators.frames import DEFAULT_BUCKET_US, bucket_of, running_agg
from recsignals.session import run_folder, stage

_FIRST = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}
_AGAIN = {"sum": "sum", "count": "sum", "max": "max", "min": "min"}


def _joined(fn: str, earlier, own):
    """Two states of one measure as one; null where neither holds a value."""
    if fn in ("max", "min"):
        return (F.greatest if fn == "max" else F.least)(earlier, own)
    return F.coalesce(earlier + own, own, earlier)


@dataclass
class HistoryStore:
    """``measures``: (name, fn, column) with fn in sum/count/max/min; column None with fn count counts rows."""

    spark: SparkSession
    keys: list[str]
    ts: str
    measures: list[tuple[str, str, str | None]]
    buckets: int = 64
    bucket_us: int = DEFAULT_BUCKET_US
    location: str | None = None
    name: str = field(default_factory=lambda: f"history_{uuid.uuid4().hex}")

    def __post_init__(self):
        self.location = self.location or f"{run_folder(self.spark)}/{self.name}"
        self.names = [n for n, _, _ in self.measures]

    def _table(self, kind: str) -> str:
        return f"{self.name}_{kind}"

    def _exists(self) -> bool:
        return self.spark.catalog.tableExists(self._table("rows"))

    def _write(self, df: DataFrame, kind: str, by: list[str]) -> None:
        table = self._table(kind)
        df = df.repartition(self.buckets, *by)  # one file per bucket
        if not self.spark.catalog.tableExists(table):
            (df.write.partitionBy("batch").bucketBy(self.buckets, *by).sortBy(*dict.fromkeys([*by, "__o"]))
             .format("parquet").option("path", f"{self.location}/{kind}").saveAsTable(table))
            return
        setting = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, "dynamic")
        try:
            df.select(*self.spark.table(table).columns).write.insertInto(table, overwrite=True)
        finally:
            self.spark.conf.set(setting, before)

    def append(self, log: DataFrame) -> "HistoryStore":
        """Adds the rows of ``log``, all later than those of earlier batches; an empty log adds nothing."""
        own = log.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*self.keys, self.ts]))
        own = own.groupBy(*self.keys, self.ts).agg(*[_FIRST[fn](F.lit(1) if c is None else F.col(c)).alias(n) for n, fn, c in self.measures])
        own = stage(own, "history-new")
        batch = own.agg(F.min(micros(self.ts))).first()[0]
        if batch is None:
            return self
        running = running_agg(own, self.keys, self.ts, [(f"__s_{n}", _AGAIN[fn], n) for n, fn, _ in self.measures], bucket_us=self.bucket_us)
        state = [F.col(f"__s_{n}").cast(own.schema[n].dataType).alias(n) for n in self.names]
        rows = running.select(*self.keys, self.ts, micros(self.ts).alias("__o"), *state)
        if self._exists():
            last = self.spark.table(self._table("last")).where(F.col("batch") < batch)
            end = last.agg(F.max("__o")).first()[0]
            if end is not None and end >= batch:
                raise ValueError("rows at or before the end of an earlier batch")
            later = self.spark.table(self._table("last")).where(F.col("batch") > batch)
            if not later.isEmpty():
                raise ValueError("only the newest batch can be appended again")
            before = last.groupBy(*self.keys).agg(F.max(F.struct("__o", *self.names)).alias("__p"))
            rows = rows.join(before, self.keys, "left")
            rows = rows.select(*self.keys, self.ts, "__o", *[_joined(fn, F.col("__p")[n], F.col(n)).cast(own.schema[n].dataType).alias(n) for n, fn, _ in self.measures])
        rows = stage(rows.withColumn("__b", bucket_of(F.col("__o"), self.bucket_us)).withColumn("batch", F.lit(batch).cast("bigint")), "history-rows")
        newest = rows.groupBy(*self.keys, "__b", "batch").agg(F.max(F.struct("__o", *self.names)).alias("__p"))
        self._write(rows, "rows", [*self.keys, "__b"])
        self._write(newest.select(*self.keys, "__b", F.col("__p")["__o"].alias("__o"), *[F.col("__p")[n].alias(n) for n in self.names], "batch"), "last", self.keys)
        return self

    def rows(self) -> DataFrame:
        """(keys, time, states) of all batches."""
        return self.spark.table(self._table("rows")).select(*self.keys, self.ts, *self.names)

    def attach(self, left: DataFrame, on: list[str], left_ts: str, strict: bool = True) -> DataFrame:
        """``left`` with the states of the latest stored row of its keys before (or at, if not ``strict``) its time."""
        names = [f"__k{i}" for i in range(len(on))]
        state = F.struct("__o", F.struct(*self.names).alias("__v")).alias("__m")
        # Renamed columns: the union keeps its inputs' partitioning only if both sides' columns are told apart from a table's own.
        stored = [F.col(c).alias(k) for c, k in zip(self.keys, names)]
        right = self.spark.table(self._table("rows")).select(*stored, F.col("__b").alias("__c"), "__o", F.lit(1 if strict else -1).alias("__side"), state)
        nothing = F.lit(None).cast(right.schema["__m"].dataType).alias("__m")
        probes = left.select(*[F.col(c).alias(k) for c, k in zip(on, names)], micros(left_ts).alias("__o")).na.drop().distinct()
        probes = probes.withColumn("__c", bucket_of(F.col("__o"), self.bucket_us))
        # Values carried into each probed bucket, from the table of last states.
        asked = probes.select(*names, "__c").distinct().repartition(self.buckets, *names).select(*names, "__c", F.lit(0).alias("__side"), nothing)
        ends = self.spark.table(self._table("last")).select(*stored, F.col("__b").alias("__c"), F.lit(1).alias("__side"), state)
        before = Window.partitionBy(*names).orderBy("__c", "__side", "__m").rowsBetween(Window.unboundedPreceding, 0)
        carry = ends.unionByName(asked).withColumn("__m", F.max("__m").over(before)).where("__side = 0 AND __m IS NOT NULL")
        carry = carry.select(*names, "__c", F.lit(-(2**63)).cast("bigint").alias("__o"), F.lit(-2).alias("__side"), "__m")
        moved = probes.select(*names, "__c", "__o", F.lit(0).alias("__side"), nothing).unionByName(carry).repartition(self.buckets, *names, "__c")
        inside = Window.partitionBy(*names, "__c").orderBy("__o", "__side").rowsBetween(Window.unboundedPreceding, 0)
        answers = right.unionByName(moved).withColumn("__m", F.max("__m").over(inside)).where("__side = 0")
        answers = answers.select(*[F.col(k).alias(f"__a{k}") for k in names], F.col("__o").alias("__at"), "__m")
        same = micros(left_ts) == F.col("__at")
        for c, k in zip(on, names):
            same = same & (F.col(c) == F.col(f"__a{k}"))
        return left.join(answers, same, "left").select(*[left[c] for c in left.columns], *[F.col("__m")["__v"][n].alias(n) for n in self.names])
