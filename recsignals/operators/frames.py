"""Window frames that stay distributed when one key is hot.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task.
Here every key, null included, is cut into time buckets, which become an extra
partition column; the part of a frame outside the bucket is restored exactly:

* :func:`range_agg` — bounded RANGE frames ``[t+lo, t+hi]``. Rows that lie
  within the widest frame of the next bucket are copied into it as *halo* rows
  (at most one copy, since the bucket is at least as wide as the frame) and
  dropped again after the window.
* :func:`running_agg` — unbounded-preceding frames (``ALL<=`` / ``ALL<``).
  Per-bucket partial aggregates are prefix-combined over the buckets of the key
  and re-enter the window as one synthetic *carry* row per bucket.
* :func:`row_index` — 1-based position per key in time order, via the same
  carry row holding the count of earlier buckets.

One plan serves every key and every input size; nothing is collected. Rows of a
key at one time are peers: each reads the same frame. Callers whose keys are
dense inside a bucket reduce the log to (key, time) first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsignals.functions.expr import DAY_US, micros

DEFAULT_BUCKET_US = 7 * DAY_US

_T, _B, _H, _K = "__t", "__b", "__halo", "__kind"


def bucket_of(t_us: Column, width_us: int) -> Column:
    """floor(t / width) in exact integer arithmetic."""
    w = F.lit(int(width_us))
    return ((t_us - F.pmod(t_us, w)) / w).cast("bigint")


def _with_bucket(df: DataFrame, ts: str, width: int) -> DataFrame:
    return df.withColumn(_T, micros(ts)).withColumn(_B, bucket_of(F.col(_T), width))


def squares(df: DataFrame, keys: list[str], cols: list[str]) -> tuple[DataFrame, dict[str, tuple[str, str]]]:
    """Adds per column the value and square that a variance is summed from.

    Integers become exact decimals. Other numbers are taken relative to their
    key's mean, which leaves the variance as it is and keeps the sums small."""
    kinds = dict(df.dtypes)
    exact = {c for c in cols if kinds[c] in ("tinyint", "smallint", "int", "bigint")}
    rest = [c for c in dict.fromkeys(cols) if c not in exact]
    if rest:
        means = df.groupBy(*keys).agg(*[F.avg(c).alias(f"__mean_{c}") for c in rest])
        same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys], F.lit(True))
        df = df.join(means.withColumnsRenamed({k: f"__key_{k}" for k in keys}), same, "left").drop(*[f"__key_{k}" for k in keys])
    out = {c: (f"__x_{c}", f"__xx_{c}") for c in cols}
    for c, (x, xx) in out.items():
        v = F.col(c).cast("decimal(19,0)") if c in exact else F.col(c).cast("double") - F.col(f"__mean_{c}")
        df = df.withColumn(x, v).withColumn(xx, F.col(x) * F.col(x))
    return df.drop(*[f"__mean_{c}" for c in rest]), out


def spread(n: Column, s: Column, q: Column) -> Column:
    """Sample standard deviation from a count and sums of :func:`squares`."""
    top = n * q - s * s  # exact for decimals
    return F.when(n > 1, F.sqrt(F.greatest(top.cast("double"), F.lit(0.0)) / n.cast("double") / (n - 1).cast("double")))


def _agg(fn: str, c: Column) -> Column:
    return {
        "sum": F.sum, "count": F.count, "avg": F.avg, "mean": F.avg, "min": F.min,
        "max": F.max, "std": F.stddev_samp, "stddev": F.stddev_samp,
    }[fn](c)


def range_agg(df: DataFrame, keys: list[str], ts: str, specs: list[tuple],
              frames: dict[str, tuple[int, int]], bucket_us: int | None = None, few: bool = False) -> DataFrame:
    """Add RANGE-frame aggregates over ``ts`` per ``keys``.

    ``frames``: label -> (lo_us, hi_us) offsets, e.g. ``{"24h": (-24*H, -1)}``
    for ``RANGE BETWEEN 24 HOURS PRECEDING AND 1 MICROSECOND PRECEDING``.
    ``specs``: (alias, fn, column, frame_label) with fn in
    sum/count/avg/min/max/std. ``few``: no key is hot (:mod:`recsignals.operators.hot`);
    windows by key alone, which move nothing if ``df`` lies together by key.
    """
    if few:
        w = Window.partitionBy(*keys).orderBy(_T)
        outs = [_agg(fn, F.col(c)).over(w.rangeBetween(*frames[fr])).alias(alias) for alias, fn, c, fr in specs]
        return df.withColumn(_T, micros(ts)).select("*", *outs).drop(_T)
    widest = max(-lo for lo, _ in frames.values())
    width = max(int(bucket_us or DEFAULT_BUCKET_US), int(widest))
    d = _with_bucket(df, ts, width)
    near_next = F.col(_T) >= (F.col(_B) + 1) * F.lit(width) - F.lit(int(widest))
    d = (d.withColumn(_H, F.explode(F.when(near_next, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
         .withColumn(_B, F.col(_B) + F.col(_H)))
    w = Window.partitionBy(*keys, _B).orderBy(_T)
    outs = [_agg(fn, F.col(c)).over(w.rangeBetween(*frames[fr])).alias(alias)
            for alias, fn, c, fr in specs]
    return d.select("*", *outs).where(F.col(_H) == 0).drop(_T, _B, _H)


_NEEDS = {"sum": "sn", "count": "n", "avg": "sn", "mean": "sn", "max": "x", "min": "m",
          "std": "vnq", "stddev": "vnq", "index": "n"}


def running_agg(df: DataFrame, keys: list[str], ts: str, specs: list[tuple],
                include_current: bool = True, bucket_us: int | None = None, few: bool = False) -> DataFrame:
    """Unbounded-preceding RANGE aggregates: ``ALL<=`` (peers included) when
    ``include_current`` else ``ALL<`` (strictly earlier times).

    ``specs``: (alias, fn, column) with fn in sum/count/avg/min/max/std;
    ``column`` None with fn count means ``count(*)``, with fn index the row's
    1-based position in its key (peers in any order).  ``std`` is the sample
    standard deviation from :func:`squares`. ``few``: no key is hot; windows by key alone, no carry.
    """
    width = int(bucket_us or DEFAULT_BUCKET_US)
    columns = df.columns
    df, sq = squares(df, keys, [c for _, fn, c in specs if fn in ("std", "stddev")])
    need: dict = {}
    for _, fn, c in specs:
        need.setdefault(c, set()).update(_NEEDS[fn])
    names: dict = {}
    comp = []
    for i, (c, parts) in enumerate(need.items()):
        x = F.lit(1).cast("bigint") if c is None else F.col(c)
        nm = {p: f"__{p}{i}" for p in sorted(parts)}
        names[c] = nm
        if "s" in nm:
            comp.append(x.alias(nm["s"]))
        if "n" in nm:
            comp.append(F.when(x.isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias(nm["n"]))
        if "x" in nm:
            comp.append(x.alias(nm["x"]))
        if "m" in nm:
            comp.append(x.alias(nm["m"]))
        if "q" in nm:
            comp += [F.col(sq[c][0]).alias(nm["v"]), F.col(sq[c][1]).alias(nm["q"])]
    real = (df.withColumn(_T, micros(ts)) if few else _with_bucket(df, ts, width)).withColumn(_K, F.lit(1)).select("*", *comp)

    def combine(p, e):
        return F.max(e) if p == "x" else F.min(e) if p == "m" else F.sum(e)

    # per-bucket partial aggregates, then the exclusive prefix over the buckets
    # of the key (one small row per (key, bucket))
    allp = [(p, n) for nm in names.values() for p, n in nm.items()]
    u, inside = real, list(keys)
    if not few:
        totals = real.groupBy(*keys, _B).agg(*[combine(p, F.col(n)).alias(n) for p, n in allp])
        wp = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
        carry = (totals.select(*keys, _B, F.count(F.lit(1)).over(wp).alias("__prior"),
                               *[combine(p, F.col(n)).over(wp).alias(n) for p, n in allp])
                 .where(F.col("__prior") > 0).drop("__prior")
                 .withColumn(_T, F.col(_B) * F.lit(width) - F.lit(1)).withColumn(_K, F.lit(0)))
        u, inside = real.unionByName(carry, allowMissingColumns=True), [*keys, _B]
    hi = 0 if include_current else -1
    w = Window.partitionBy(*inside).orderBy(_T).rangeBetween(Window.unboundedPreceding, hi)
    acc = {c: {p: combine(p, F.col(n)).over(w) for p, n in nm.items()} for c, nm in names.items()}
    outs = []
    for alias, fn, c in specs:
        a = acc[c]
        N = F.coalesce(a["n"], F.lit(0)) if "n" in a else None
        if fn == "sum":
            e = F.when(N > 0, a["s"])
        elif fn == "count":
            e = N
        elif fn == "index":
            e = F.sum(names[c]["n"]).over(Window.partitionBy(*inside).orderBy(_T).rowsBetween(Window.unboundedPreceding, 0))
        elif fn == "max":
            e = a["x"]
        elif fn == "min":
            e = a["m"]
        elif fn in ("avg", "mean"):
            e = F.when(N > 0, a["s"].cast("double") / N)
        else:
            e = spread(N, a["v"], a["q"])
        outs.append(e.alias(alias))
    kept = F.col(_K) == 1
    return u.select(*columns, _K, *outs).where(kept).drop(_K)


def row_index(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str] | None = None,
              alias: str = "row_idx", bucket_us: int | None = None) -> DataFrame:
    """1-based row position per key ordered by (ts, *tiebreak)."""
    width = int(bucket_us or DEFAULT_BUCKET_US)
    real = _with_bucket(df, ts, width).withColumn(_K, F.lit(1)).withColumn("__n", F.lit(1).cast("bigint"))
    totals = real.groupBy(*keys, _B).agg(F.count(F.lit(1)).alias("__n"))
    wp = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    carry = (totals.select(*keys, _B, F.sum("__n").over(wp).alias("__n")).where(F.col("__n").isNotNull())
             .withColumn(_T, F.col(_B) * F.lit(width) - F.lit(1)).withColumn(_K, F.lit(0)))
    u = real.unionByName(carry, allowMissingColumns=True)
    order = [F.col(_T), F.col(_K)] + [F.col(c).asc_nulls_first() for c in (tiebreak or [])]
    w = Window.partitionBy(*keys, _B).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (u.select("*", F.sum("__n").over(w).alias(alias)).where(F.col(_K) == 1)
            .drop(_T, _B, _K, "__n"))
