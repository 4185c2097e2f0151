"""Best-fit packing of token sequences by the sum-of-squares rule.

Every document's ids (plus an end id) are cut into pieces of at most
``capacity`` ids; only longer documents are cut. A piece goes to the open bin,
or a new one, after which the sum over all gaps of (number of open bins with
that gap) squared is smallest.

Scale: tokenisation is one map over the texts, written once as a narrow table
of pieces. Full pieces are sequences of their own. The rest is packed in shards
of bounded size, largest piece first. Bins still open after a shard are packed
again as items in ever fewer shards, until one shard is left or merging stops
saving bins. So no task holds more than one shard, whatever the input.

Null text is empty (one piece holding only the end id); a null id stays null.
Repeated rows are packed as rows of their own. Extra columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsignals.llm.common import NULL_ID, buckets, id_back, keyed, small_side, stage
from recsignals.llm.tokens import encoder, forget, texts

#: Pieces or open bins that one task packs.
SHARD_ITEMS = 20_000


class SumOfSquares:
    """Open bins by fill level; ``place`` returns (bin, offset) and the bin's new fill."""

    def __init__(self, capacity: int, total: int):
        """total: summed item sizes. Once the bins that they need at least are open, a further one is the last resort."""
        self.capacity, self.least = capacity, -(-total // capacity)
        self.after = np.zeros(capacity + 1)  # cost of one more bin at a level; a full bin is no longer open
        self.after[capacity] = -0.5
        self.before = np.full(capacity + 1, -1e18)  # gain of one bin less at a level; no bin: impossible
        self.before[0] = 0.5  # opening a new bin costs a little more than moving one
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.fill: list[int] = []

    def place(self, size: int) -> tuple[int, int]:
        level = int(np.argmin(self.after[size:] - self.before[: self.capacity + 1 - size]))
        if level:
            b = self.open[level].pop()
            self.after[level] -= 1
            self.before[level] = self.after[level] or -1e18
        else:
            b = len(self.fill)
            self.fill.append(0)
            if len(self.fill) == self.least:
                self.before[0] = -1e9
        now = level + size
        self.fill[b] = now
        if now < self.capacity:
            self.open[now].append(b)
            self.after[now] += 1
            self.before[now] = self.after[now]
        return b, level


def pack(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pack items largest first: (bin of each item, its offset, fill of each bin)."""
    rule = SumOfSquares(capacity, int(sizes.sum()))
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable"):
        bins[i], offsets[i] = rule.place(int(sizes[i]))
    return bins, offsets, np.asarray(rule.fill, np.int64)


def pieces(docs: DataFrame, vocabulary: str, id_col="doc_id", text_col="text", capacity=2048, end_id=0) -> DataFrame:
    """One row per piece: kid, piece, start, length, ids_crc32."""
    end = np.asarray([end_id], "<u4").tobytes()
    step = 4 * capacity

    def cut(batches):
        encode = encoder(vocabulary)
        for batch in batches:
            rows = ([], [], [], [], [])
            for kid, text in zip(batch.column("kid").to_pylist(), texts(batch.column("text"))):
                ids = encode(text) + end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    for c, v in zip(rows, (kid, k, at // 4, len(part) // 4, zlib.crc32(part))):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["kid", "piece", "start", "length", "ids_crc32"]
            )
        forget(vocabulary)

    return keyed(docs, id_col, text_col).select("kid", "text").mapInArrow(cut, "kid long, piece int, start long, length long, ids_crc32 long")


def _pack_shards(items: DataFrame, level: int, capacity: int) -> DataFrame:
    """items (item, size, shard) -> item, bin, offset, fill. Bin numbers are unique over levels and shards."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "item"], ascending=[False, True], kind="stable")
        bins, offsets, fill = pack(pdf["size"].to_numpy(), capacity)
        shard = int(pdf["shard"].iloc[0])
        return pd.DataFrame({"item": pdf["item"], "bin": (level << 58) + (shard << 24) + bins, "offset": offsets, "fill": fill[bins]})

    return items.groupBy("shard").applyInPandas(run, "item long, bin long, offset long, fill long")


def best_fit(cut: DataFrame, capacity: int = 2048, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (kid, piece, start, length, ids_crc32)."""
    numbered = stage(cut.withColumn("item", F.monotonically_increasing_id()), "op1-pieces")
    full = numbered.filter(F.col("length") == capacity).select("kid", "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("offset"), F.col("item").alias("sequence_id"))
    rest = numbered.filter(F.col("length") < capacity)
    n = rest.count()
    spread = buckets(n, shard_items, 1)
    placed = stage(_pack_shards(rest.select("item", F.col("length").alias("size"), F.pmod(F.xxhash64("item"), F.lit(spread)).alias("shard")), 1, capacity), "op1-level1")
    out = numbered.join(placed, "item").select("kid", "piece", "start", "length", "ids_crc32", "offset", "bin", "fill")
    level, open_bins = 1, None
    moved = placed.select("bin", "fill").filter(F.col("fill") < capacity).distinct()
    bins = moved.count() if spread > 1 else 0
    while spread > 1:
        level, spread = level + 1, buckets(bins, shard_items, 1)
        merged = stage(_pack_shards(moved.select(F.col("bin").alias("item"), F.col("fill").alias("size"), F.pmod(F.xxhash64("bin"), F.lit(spread)).alias("shard")), level, capacity), f"op1-level{level}")
        step = merged.select(F.col("item").alias("inner"), F.col("bin").alias("outer"), F.col("offset").alias("shift"))
        if open_bins is None:
            open_bins = step
        else:
            nxt = step.select(F.col("inner").alias("mid"), F.col("outer").alias("outer2"), F.col("shift").alias("shift2"))
            open_bins = stage(open_bins.join(nxt, F.col("outer") == F.col("mid"), "left").select("inner", F.coalesce("outer2", "outer").alias("outer"), (F.col("shift") + F.coalesce("shift2", F.lit(0))).alias("shift")), "op1-open")
        moved = merged.select("bin", "fill").filter(F.col("fill") < capacity).distinct()
        before, bins = bins, moved.count()
        if bins > 0.99 * before:
            break
    if open_bins is not None:
        out = out.join(small_side(open_bins, 24), F.col("bin") == F.col("inner"), "left").withColumn("offset", F.col("offset") + F.coalesce("shift", F.lit(0))).withColumn("bin", F.coalesce("outer", "bin"))
    return full.unionByName(out.withColumnRenamed("bin", "sequence_id").select(full.columns))


def pack_documents(docs: DataFrame, vocabulary: str, id_col="doc_id", text_col="text", capacity=2048, end_id=0) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    packed = best_fit(pieces(docs, vocabulary, id_col, text_col, capacity, end_id), capacity)
    return packed.select(id_back().alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
