"""Token ids of a corpus as Re-Pair grammar shards, with random access.

Per shard, frequent adjacent id pairs are replaced by nonterminals, round after
round, until no pair reaches ``min_count`` or ``max_rounds`` are done. Pairs
never cross documents. A shard stores its rules, each nonterminal's expansion
length, the remaining symbols and, per document, its first symbol and id count,
so any id range of any document decodes without the rest.

File format: a Parquet folder, one row per shard (``FORMAT``), written and
committed by Spark, so lost executors cost only their shards and any store that
Spark reads will do. Texts are range-partitioned by id; inside a partition,
shards of at most ``shard_tokens`` ids (one longer document excepted) follow in
ascending order. Global starts come from sums per partition and a running sum
inside each, not from one global window.

Null text holds only the end id; null ids come first; equal ids are ordered by
text hash. Extra columns are not read. An empty table gives an empty folder.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recsignals.llm.common import BROADCAST_BYTES, id_back, keyed
from recsignals.llm.tokens import encoder, texts
from recsignals.session import run_folder

#: Little-endian arrays: ids i8, n_tokens and first_symbol i8, rules u4 pairs, expansion u4, symbols u4.
FORMAT = "part int, shard int, shard_tokens long, first_rule long, ids binary, n_tokens binary, first_symbol binary, rules binary, expansion binary, symbols binary"
_SLOTS = 18


def _frequent_pairs(symbols: np.ndarray, last: np.ndarray, min_count: int):
    """Codes of the pairs that occur at least ``min_count`` times, where they start, and which of the codes stands there."""
    code = (symbols[:-1].astype(np.uint64) << np.uint64(32)) | symbols[1:]
    slot = ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOTS)).astype(np.int32)
    slot[last[:-1]] = 0
    heavy = np.bincount(slot, minlength=1 << _SLOTS) >= min_count  # an upper bound, so no frequent pair is missed
    at = np.flatnonzero(heavy[slot] & ~last[:-1])
    found, which, n = np.unique(code[at], return_inverse=True, return_counts=True)
    often = n >= min_count
    keep = often[which]
    return found[often], at[keep], (np.cumsum(often) - 1)[which[keep]]


def compress(symbols: np.ndarray, first: np.ndarray, first_rule: int, min_count: int, max_rounds: int):
    """Grammar of a shard: (rules, expansion lengths, symbols, first symbol of each document)."""
    last = np.zeros(len(symbols), bool)
    last[first[1:] - 1] = True
    last[-1:] = True
    rules, length = [np.zeros((0, 2), np.uint32)], [np.zeros(0, np.uint32)]
    have = 0
    for _ in range(max_rounds):
        if len(symbols) < 2:
            break
        codes, at, rank = _frequent_pairs(symbols, last, min_count)
        if not len(codes):
            break
        run = np.flatnonzero(np.diff(at, prepend=-2) != 1)  # where a run of overlapping hits begins
        first_of = (at - np.repeat(at[run], np.diff(np.append(run, len(at))))) % 2 == 0
        at, rank = at[first_of], rank[first_of]
        pair = np.stack([codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
        known = np.concatenate(length)
        size = lambda x: np.where(x < first_rule, 1, known[np.where(x < first_rule, 0, x - first_rule)] if len(known) else 1)
        rules.append(pair)
        length.append((size(pair[:, 0]) + size(pair[:, 1])).astype(np.uint32))
        symbols = symbols.copy()
        symbols[at] = first_rule + have + rank
        last[at] = last[at + 1]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, last = symbols[keep], last[keep]
        have += len(codes)
    first = np.concatenate(([0], np.flatnonzero(last)[:-1] + 1)) if len(symbols) else np.zeros(0, np.int64)
    return np.concatenate(rules), np.concatenate(length), symbols, first.astype(np.int64)


def expand(symbols: np.ndarray, rules: np.ndarray, first_rule: int) -> np.ndarray:
    """All ids of a run of symbols."""
    while len(symbols) and symbols.max() >= first_rule:
        big = symbols >= first_rule
        at = np.cumsum(np.where(big, 2, 1)) - np.where(big, 2, 1)
        out = np.empty(int(at[-1] + (2 if big[-1] else 1)), np.uint32)
        out[at[~big]] = symbols[~big]
        pair = rules[symbols[big] - first_rule]
        out[at[big]], out[at[big] + 1] = pair[:, 0], pair[:, 1]
        symbols = out
    return symbols


def read_range(shard: dict, document: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of one document of a shard row; decodes only the symbols that cover them."""
    first = np.frombuffer(shard["first_symbol"], "<i8")
    symbols = np.frombuffer(shard["symbols"], "<u4")
    own = symbols[first[document] : first[document + 1] if document + 1 < len(first) else len(symbols)]
    base, length = shard["first_rule"], np.frombuffer(shard["expansion"], "<u4")
    size = np.ones(len(own), np.int64)
    size[own >= base] = length[own[own >= base] - base]
    end = np.cumsum(size)
    a, b = int(np.searchsorted(end, start, side="right")), int(np.searchsorted(end, stop, side="left")) + 1
    skip = int(end[a - 1]) if a else 0
    return expand(own[a:b], np.frombuffer(shard["rules"], "<u4").reshape(-1, 2), base)[start - skip : stop - skip]


def write(docs: DataFrame, path: str, vocabulary: str, id_col="doc_id", text_col="text", end_id=2, first_rule=1 << 20, shard_tokens=1_000_000, min_count=64, max_rounds=8) -> None:
    """Encode every text, append ``end_id``, and write the shards to ``path`` in ascending id order."""
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * rows.rdd.getNumPartitions())
    end = np.asarray([end_id], "<u4").tobytes()

    def shards(batches):
        from pyspark import TaskContext

        part, encode = TaskContext.get().partitionId(), encoder(vocabulary)
        ids, coded, size, k = [], [], 0, 0

        def flush():
            lengths = np.asarray([len(x) // 4 for x in coded], "<i8")
            symbols = np.frombuffer(b"".join(coded), "<u4")
            rules, length, symbols, first = compress(symbols, np.cumsum(lengths) - lengths, first_rule, min_count, max_rounds)
            cells = [part, k, int(lengths.sum()), first_rule, np.asarray(ids, "<i8").tobytes(), lengths.tobytes(), first.tobytes(), rules.astype("<u4").tobytes(), length.astype("<u4").tobytes(), symbols.astype("<u4").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, [pa.int32(), pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * 6)], names=[c.split()[0] for c in FORMAT.split(", ")])

        for batch in batches:
            for kid, text in zip(batch.column("kid").to_pylist(), texts(batch.column("text"))):
                x = encode(text) + end
                if ids and size + len(x) // 4 > shard_tokens:
                    yield flush()
                    ids, coded, size, k = [], [], 0, k + 1
                ids.append(kid)
                coded.append(x)
                size += len(x) // 4
        if ids:
            yield flush()

    ordered = rows.repartitionByRange(n, "kid", "th").sortWithinPartitions("kid", "th").select("kid", "text")
    ordered.mapInArrow(shards, FORMAT).write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Decode the files: one row per document with kid, start, n_tokens, ids_crc32."""
    shards = spark.read.schema(FORMAT).parquet(path)
    sums = shards.groupBy("part").agg(F.sum("shard_tokens").alias("n")).orderBy("part").collect()  # one row per range partition
    at, starts = 0, []
    for r in sums:
        starts.append((r["part"], at))
        at += r["n"]
    inside = F.sum("shard_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("shard_tokens")
    base = spark.createDataFrame(starts, "part int, base long")
    place = shards.select("part", "shard", inside.alias("inside")).join(base, "part").select("part", "shard", (F.col("base") + F.col("inside")).alias("start"))
    place = F.broadcast(place) if len(starts) * 2**16 <= BROADCAST_BYTES else place

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["n_tokens"], "<i8")
                ids = expand(np.frombuffer(row["symbols"], "<u4"), np.frombuffer(row["rules"], "<u4").reshape(-1, 2), row["first_rule"]).astype("<u4")
                edge = np.concatenate(([0], np.cumsum(lengths)))
                raw = memoryview(ids.tobytes())
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame({"kid": np.frombuffer(row["ids"], "<i8"), "start": row["start"] + edge[:-1], "n_tokens": lengths, "ids_crc32": [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edge[:-1], edge[1:])]}), preserve_index=False
                )

    return shards.join(place, ["part", "shard"]).mapInArrow(decode, "kid long, start long, n_tokens long, ids_crc32 long")


def store(docs: DataFrame, vocabulary: str, id_col="doc_id", text_col="text", path: str | None = None, **format_options) -> DataFrame:
    """Write the files (to the run's shared folder unless ``path`` is given) and read every document back."""
    spark = docs.sparkSession
    path = path or f"{run_folder(spark)}/op10-{uuid.uuid4().hex}"
    write(docs, path, vocabulary, id_col, text_col, **format_options)
    return read(spark, path).select(id_back().alias(id_col), "start", "n_tokens", "ids_crc32")
