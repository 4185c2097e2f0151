"""As-of left join (no native Spark SQL operator exists).

For each left row, the right row with the same keys and the latest time
strictly before (``strict=True``, SQL ``ASOF ... l.t > r.t``) or at/before
(``strict=False``) the left time.  Unmatched rows and null keys get nulls.

Plan, built so that a key holding a large share of rows is still spread out
and features are moved as seldom as possible:

1. *probes* — distinct (keys, left time).  The answer depends only on these,
   so duplicated candidates (a popular item shown in many sessions at the
   same hour) collapse before any shuffle (partial aggregation).
2. every key is cut into time buckets (:mod:`recsignals.operators.frames`).
   Probes and the times of right rows are sorted together inside (keys, bucket); the
   running maximum is the time of the latest right row. Right rows at the
   probe's own time sort after the probe (strict) or before it (inclusive).
3. matches from earlier buckets come from a *carry* row at the start of each
   probed bucket: the latest time of the last earlier non-empty bucket,
   found on a table of one row per (key, bucket).
4. each left row gets its probe's answer, a time, and then the features of (keys, that
   time): two equi-joins, broadcast when Spark's size estimate allows; AQE
   splits skewed partitions otherwise.

Ties between right rows with the same time resolve to the greatest feature
struct, so results are deterministic; it is the only exchange of the features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsignals.operators.frames import DEFAULT_BUCKET_US, bucket_of
from recsignals.operators.hot import Sizes
from recsignals.functions.expr import micros


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_ts: str,
              right_ts: str | None = None, strict: bool = True,
              right_cols: list[str] | None = None, right_on: list[str] | None = None,
              bucket_us: int | None = None,
              probes_from: DataFrame | None = None, stage_right: bool = False,
              times_from: DataFrame | None = None, few_ties: bool = False, few_probes: bool = False,
              sizes: Sizes | None = None) -> DataFrame:
    """Left as-of join; adds ``right_cols`` (default: all non-key right
    columns, including the right time column when it is named differently).

    ``probes_from``: a cheaper frame with the same ``on`` / ``left_ts``
    values as ``left`` (e.g. the stored candidate table when ``left`` is a
    long chain of joins), so the chain is not evaluated twice.
    ``stage_right``: write the (projected) right side to the checkpoint
    folder first; use it when ``right`` is itself a computed feature table,
    which this operator reads more than once.
    ``times_from``: a cheaper frame with the same keys and times as ``right``;
    the features are then read once and need no staging.
    ``few_ties``: ``right`` rarely repeats keys and time, so its ties resolve after
    the exchange of the features, without a sort before it.
    ``few_probes``: distinct (keys, left time) are far fewer than left rows; they
    fetch the features, and each left row moves once.
    ``sizes``: key sizes of both sides (:mod:`recsignals.operators.hot`); left and right
    rows of keys with few rows are then exchanged by key once, and only hot keys take the plan above."""
    right_ts = right_ts or left_ts
    right_on = right_on or on
    width = int(bucket_us or DEFAULT_BUCKET_US)
    if right_cols is None:
        right_cols = [c for c in right.columns if c not in right_on and c != right_ts]
        if right_ts != left_ts:
            right_cols.append(right_ts)
    if sizes is not None:
        from recsignals.operators.asof_many import Source, asof_once

        return asof_once(left, on, left_ts, [Source(right, tuple(right_on), right_ts, tuple(right_cols), strict)], sizes)
    kn = [f"__k{i}" for i in range(len(on))]

    if stage_right:
        from recsignals.session import stage
        right = stage(right.select(*dict.fromkeys([*right_on, right_ts, *right_cols])), "asof-right")
    src = probes_from if probes_from is not None else left
    probes = (src.select(*[F.col(c).alias(k) for c, k in zip(on, kn)], micros(left_ts).alias("__t"))
              .where(F.col("__t").isNotNull())
              .where(F.lit(True) if not kn else F.expr(" AND ".join(f"{k} IS NOT NULL" for k in kn)))
              .distinct())
    rv = F.struct(*[F.col(c) for c in right_cols]).alias("__v")
    rights = (right.select(*[F.col(c).alias(k) for c, k in zip(right_on, kn)],
                           micros(right_ts).alias("__t"), rv)
              .where(F.col("__t").isNotNull())
              .where(F.lit(True) if not kn else F.expr(" AND ".join(f"{k} IS NOT NULL" for k in kn))))
    probes = probes.withColumn("__b", bucket_of(F.col("__t"), width))
    times = rights.select(*kn, "__t")
    if times_from is not None:
        times = times_from.select(*[F.col(c).alias(k) for c, k in zip(right_on, kn)], micros(right_ts).alias("__t")).dropna()
    times = times.withColumn("__b", bucket_of(F.col("__t"), width))
    none = F.lit(None).cast("bigint").alias("__m")

    # main pass inside (keys, bucket): carry first, then time order
    probe_order, right_order = (0, 1) if strict else (1, 0)
    main = (probes.select(*kn, "__b", F.col("__t").alias("__o"), F.lit(probe_order).alias("__side"), none)
            .unionByName(times.select(*kn, "__b", F.col("__t").alias("__o"), F.lit(right_order).alias("__side"),
                                      F.col("__t").alias("__m"))))
    # carry: latest right time of earlier buckets, per probed bucket
    last_per_bucket = times.groupBy(*kn, "__b").agg(F.max("__t").alias("__m"))
    probed_buckets = probes.select(*kn, "__b").distinct()
    both = (probed_buckets.select(*kn, "__b", none, F.lit(0).alias("__side"))
            .unionByName(last_per_bucket.withColumn("__side", F.lit(1))))
    wb = Window.partitionBy(*kn).orderBy("__b", "__side").rowsBetween(Window.unboundedPreceding, 0)
    carry = (both.select(*kn, "__b", "__side", F.last("__m", ignorenulls=True).over(wb).alias("__m"))
             .where((F.col("__side") == 0) & F.col("__m").isNotNull())
             .select(*kn, "__b", F.lit(-(2**63)).cast("bigint").alias("__o"), "__m"))
    main = main.unionByName(carry.withColumn("__side", F.lit(-1)))
    w = Window.partitionBy(*kn, "__b").orderBy("__o", "__side").rowsBetween(Window.unboundedPreceding, 0)
    answers = (main.select(*kn, "__o", "__side", F.max("__m").over(w).alias("__m"))
               .where((F.col("__side") == probe_order) & F.col("__m").isNotNull())
               .select(*kn, F.col("__o").alias("__ta"), "__m"))
    if few_ties:
        tied = Window.partitionBy(*kn, "__t").orderBy("__v")
        best = rights.withColumn("__next", F.lead(F.lit(1)).over(tied)).where(F.col("__next").isNull()).drop("__next")
    else:
        best = rights.groupBy(*kn, "__t").agg(F.max("__v").alias("__v"))
    best = best.withColumnsRenamed({k: f"__r{k}" for k in kn})

    lt = left.withColumn("__tl", micros(left_ts))
    cond = [F.col(c) == F.col(k) for c, k in zip(on, kn)] + [F.col("__tl") == F.col("__ta")]
    if few_probes:
        here = [F.col(k) == F.col(f"__r{k}") for k in kn] + [F.col("__m") == F.col("__t")]
        fetched = answers.join(best, here, "left").select(*kn, "__ta", "__v")
        return lt.join(fetched, cond, "left").select(*[F.col(c) for c in left.columns], *[F.col("__v")[c].alias(c) for c in right_cols])
    found = lt.join(answers, cond, "left").select(*[F.col(c) for c in left.columns], "__m")
    same = [F.col(c) == F.col(f"__r{k}") for c, k in zip(on, kn)] + [F.col("__m") == F.col("__t")]
    return found.join(best, same, "left").select(*[F.col(c) for c in left.columns],
                                                 *[F.col("__v")[c].alias(c) for c in right_cols])
