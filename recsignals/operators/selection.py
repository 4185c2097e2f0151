"""Feature selection (C32): drop one feature of every pair whose absolute
correlation exceeds a threshold, keeping the one more correlated with the
target.

All Pearson correlations come from one pass. Each task adds up, for every block
of columns against all columns, four matrix products: counts, sums, sums of
squares and cross products over the rows where both columns have a value. Values
are taken relative to their column's mean, which leaves correlations as they are
and keeps the sums small. The blocks are summed block by block; the driver gets
the k x k sums of k features, where the greedy choice runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of a block, and rows that a task turns into a matrix at a time.
BLOCK_COLUMNS, BLOCK_ROWS = 64, 4_096


def gram(df: DataFrame, cols: list[str]) -> np.ndarray:
    """(4, k, k): per pair the count, the sum of the row's column, the sum of its squares and the cross products, over the
    rows where both columns have a finite value. Sums are relative to the columns' means."""
    from recsignals.session import stage

    k = len(cols)
    # stored, since the means and the sums each read it
    x = stage(df.select(*[F.when(F.abs(F.col(f"`{c}`").cast("double")) < float("inf"), F.col(f"`{c}`").cast("double")).alias(f"c{i}") for i, c in enumerate(cols)]), "gram")
    means = x.agg(*[F.avg(f"c{i}").alias(f"c{i}") for i in range(k)]).first()
    shift = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])

    def add(batches):
        total = np.zeros((4, k, k))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                v = np.stack([c.to_numpy(zero_copy_only=False) for c in part.columns], 1).astype(np.float64)
                there = ~np.isnan(v)
                v, there = np.where(there, v - shift, 0.0), there.astype(np.float64)
                total += np.stack([there.T @ there, v.T @ there, (v * v).T @ there, v.T @ v])
        for b in range(0, k, BLOCK_COLUMNS):
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([total[:, b : b + BLOCK_COLUMNS].tobytes()], pa.binary())], names=["block", "sums"])

    def combine(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in parts:
            for s in part.column("sums"):
                own = np.frombuffer(s.as_py())
                total = own.copy() if total is None else total + own
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "sums"])

    out = np.zeros((4, k, k))
    for r in x.mapInArrow(add, "block int, sums binary").groupBy("block").applyInArrow(combine, "block int, sums binary").collect():
        own = np.frombuffer(r["sums"]).reshape(4, -1, k)
        out[:, r["block"] : r["block"] + own.shape[1]] = own
    return out


def correlations(df: DataFrame, cols: list[str]) -> np.ndarray:
    """Absolute Pearson correlations of all pairs; 0 where one isn't defined (a constant column, fewer than two common rows)."""
    n, s, q, c = gram(df, cols)
    with np.errstate(all="ignore"):
        own, other = n * q - s * s, n * q.T - s.T * s.T
        r = np.abs((n * c - s * s.T) / np.sqrt(own * other))
        # A constant column's spread is rounding noise.
        flat = (own <= 1e-12 * n * q) | (other <= 1e-12 * n * q.T) | (n < 2)
    return np.where(flat | ~np.isfinite(r), 0.0, np.minimum(r, 1.0))


def prune_correlated(df: DataFrame, features: list[str], target: str, threshold: float = 0.98) -> DataFrame:
    """One row per feature: ``feature``, ``target_corr``, ``kept`` (1/0) and
    ``dropped_for`` (the feature it was too correlated with). A correlation
    that is not defined (a constant column) counts as 0; missing, infinite and
    NaN values don't count."""
    k = len(features)
    size = correlations(df, [*features, target])
    tcorr = size[:k, k].tolist()
    i, j = np.nonzero(np.triu(size[:k, :k] > threshold, 1))
    pairs = sorted(zip(size[i, j].tolist(), i.tolist(), j.tolist()), reverse=True)
    kept, why = [True] * k, [None] * k
    for _, i, j in pairs:
        if kept[i] and kept[j]:
            drop, keep = (i, j) if tcorr[i] < tcorr[j] else (j, i)
            kept[drop], why[drop] = False, features[keep]
    rows = [(features[i], tcorr[i], int(kept[i]), why[i]) for i in range(k)]
    return df.sparkSession.createDataFrame(rows, "feature string, target_corr double, kept long, dropped_for string")
