"""Benchmark decontamination by winnowing.

Words are hashed, and of the word ``k``-grams in every window of ``window``
words the smallest hash is that window's fingerprint. Two texts that share a
window share its fingerprint, so looking up document fingerprints among those
of the benchmark misses no shared span of ``window`` words or more. Hits are
extended: the whole window's hash must occur in the benchmark, and its words are
compared with the item's. An item of fewer words is one window of its own
length, looked up by that length.

Scale: one map over the texts, no shuffle. The benchmark is held in blocks of
bounded size, each broadcast in turn and run against all documents; with more
than one block, the hits (not the texts) are merged per document.

A word is a maximal run of a-z, 0-9 and all non-ASCII characters after A-Z is
lower-cased. Null text has no words; an item without words or without text is
never hit; a null item id counts as the empty string; repeated item ids count
once. Repeated rows each get their row; extra columns are not read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsignals.llm.common import buckets, id_back, keyed, stage, text_volume
from recsignals.llm.textbuf import PrefixHash, ascii_lower, blocks, gram_hashes, text_view, word_spans, word_table

WORD_BYTES = word_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: Bytes of benchmark text in one broadcast block.
BENCHMARK_BLOCK = 8 << 20
_FLAG_BITS = 20


class Index:
    """Windows and fingerprints of one block of benchmark items."""

    def __init__(self, items: list[tuple[str, str]], window: int, k: int):
        self.ids = sorted({i for i, _ in items})
        number = {x: n for n, x in enumerate(self.ids)}
        buf, off = text_view(pa.array([t for _, t in items], pa.large_string()))
        buf = ascii_lower(buf)
        start, end, first = word_spans(buf, off, WORD_BYTES)
        h = PrefixHash(buf).ranges(start, end)
        self.words = [buf[a:b].tobytes() for a, b in zip(start, end)]
        self.window, self.k = window, k
        at: dict[int, list[tuple[int, int]]] = {}  # window length -> (first word, item number)
        for n, (item, _) in enumerate(items):
            a, z = int(first[n]), int(first[n + 1])
            if z - a >= window:
                at.setdefault(window, []).extend((i, number[item]) for i in range(a, z - window + 1))
            elif z > a:
                at.setdefault(z - a, []).append((a, number[item]))
        self.lengths = {}
        for m, places in at.items():
            p = np.asarray(places, np.int64)
            g = gram_hashes(h, m)[p[:, 0]]
            order = np.argsort(g, kind="stable")
            self.lengths[m] = (g[order], p[order, 0], p[order, 1])
        self.fingerprints = np.zeros(0, np.uint64)
        if window in self.lengths:
            self.fingerprints = np.unique(fingerprints(gram_hashes(h, k), window - k + 1)[np.unique(self.lengths[window][1])])
        self.flags = np.zeros(1 << _FLAG_BITS, bool)
        self.flags[self.fingerprints >> np.uint64(64 - _FLAG_BITS)] = True

    def windows(self, h: np.ndarray, row: np.ndarray):
        """(first word, length, entry) of candidate windows; row: the row of each word."""
        for m, (keys, first, item) in self.lengths.items():
            if len(h) < m:
                continue
            inside = row[: len(row) - m + 1] == row[m - 1 :]
            if m == self.window:
                f = fingerprints(gram_hashes(h, self.k), m - self.k + 1)
                place = np.flatnonzero(self.flags[f >> np.uint64(64 - _FLAG_BITS)] & inside)
                place = place[np.isin(f[place], self.fingerprints)]
                g = gram_hashes_at(h, place, m)
            else:
                place = np.flatnonzero(inside)
                g = gram_hashes(h, m)[place]
            lo, hi = np.searchsorted(keys, g), np.searchsorted(keys, g, side="right")
            for i, a, b in zip(place[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                yield i, m, first[a:b], item[a:b]


def fingerprints(grams: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each run of ``width`` gram hashes."""
    out, have = grams, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def gram_hashes_at(h: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """gram_hashes(h, n)[place] without the others."""
    if not len(place):
        return np.zeros(0, np.uint64)
    return gram_hashes(h[place[:, None] + np.arange(n)].ravel(), n)[::n]


def hits_of_block(buf: np.ndarray, off: np.ndarray, index: Index):
    """Per row: word count, merged hit spans [first, end) in words, item numbers."""
    buf = ascii_lower(buf)
    start, end, first = word_spans(buf, off, WORD_BYTES)
    n = np.diff(first)
    h = PrefixHash(buf).ranges(start, end)
    row = np.repeat(np.arange(len(n)), n)
    spans: dict[int, list[list[int]]] = {}
    items: dict[int, set[int]] = {}
    for i, m, firsts, numbers in sorted(index.windows(h, row), key=lambda x: x[0]):
        own = [buf[a:b].tobytes() for a, b in zip(start[i : i + m], end[i : i + m])]
        same = [int(x) for f, x in zip(firsts, numbers) if index.words[f : f + m] == own]
        if same:
            r = int(row[i])
            a = i - int(first[r])
            items.setdefault(r, set()).update(same)
            mine = spans.setdefault(r, [])
            if mine and a <= mine[-1][1]:
                mine[-1][1] = max(mine[-1][1], a + m)
            else:
                mine.append([a, a + m])
    return n, spans, items


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def _scan(docs: DataFrame, shared) -> DataFrame:
    def run(batches):
        index = shared.value
        for batch, buf, off in blocks(batches, "text"):
            n, spans, items = hits_of_block(buf, off, index)
            rows = range(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("kid"),
                    batch.column("th"),
                    pa.array(n, pa.int64()),
                    pa.array([[{"first": a, "end": b} for a, b in spans.get(r, ())] for r in rows], _SPANS),
                    pa.array([[index.ids[x] for x in sorted(items.get(r, ()))] for r in rows], pa.list_(pa.string())),
                ],
                names=["kid", "th", "n_words", "spans", "items"],
            )

    return docs.mapInArrow(run, "kid long, th long, n_words long, spans array<struct<first:bigint,end:bigint>>, items array<string>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text="text", window=10, k=5, block_bytes=BENCHMARK_BLOCK) -> DataFrame:
    """Per document: n_words, spans (hit word ranges, merged), items (sorted ids as strings), and ``th``."""
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    items = benchmark.select(F.coalesce(benchmark[item_col].cast("string"), F.lit("")).alias("id"), benchmark[item_text].cast("string").alias("text")).filter("text is not null")
    n = buckets(text_volume(items, "text"), block_bytes, 1)
    found = []
    for b in range(n):
        block = items if n == 1 else items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b)
        shared = spark.sparkContext.broadcast(Index([(r.id, r.text) for r in block.collect()], window, k))
        found.append(_scan(rows, shared))
    if n == 1:
        out = found[0]
    else:
        hits = functools.reduce(DataFrame.unionByName, [f.filter(F.size("items") > 0) for f in found])
        hits = stage(hits, "op5-hits").groupBy("kid", "th").agg(
            F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
        )
        none = F.expr("cast(array() as array<struct<first:bigint,end:bigint>>)")
        # Sorted spans, merged: the last one grows while the next begins inside it or at its end.
        merged = F.aggregate(
            "spans",
            none,
            lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["first"]), F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(F.element_at(acc, -1)["first"].alias("first"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))))).otherwise(F.concat(acc, F.array(x))),
        )
        out = found[0].select("kid", "th", "n_words").join(hits.select("kid", "th", merged.alias("spans"), "items"), ["kid", "th"], "left").withColumn("spans", F.coalesce("spans", none)).withColumn("items", F.coalesce("items", F.expr("cast(array() as array<string>)")))
    return out.select(id_back().alias(id_col), "th", "n_words", "spans", "items")


def summary(found: DataFrame, id_col="doc_id") -> DataFrame:
    """The digest columns of ``decontaminate``'s rows."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["first"])
    return found.select(id_col, "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("items") > 0).alias("contaminated"))
