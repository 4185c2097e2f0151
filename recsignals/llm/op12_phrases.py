"""Collocations of two to five words, counted exactly by dynamic itemset counting.

Method. The texts lie in ``shards`` equal shards that are scanned in a cycle, one
per step. Words are counted from the first step on. A longer phrase becomes active
at the end of the step in which the later of its two subphrases (without its last,
without its first word) reaches the threshold; from then on it is counted, next to
all other lengths, until it has seen every shard once. The cycle goes on until no
phrase is active; with s shards that is after 5 s steps at the latest.

What tells tasks which phrases are active is a table of fixed size (``SLOT_BITS``):
by hash of language and phrase, the step in which a phrase reached the threshold,
the latest step where several share a slot. So a task may count a phrase too early
or once more, never too late: its state holds which shards it was counted in, and a
shard's count, which is the same each time, enters once. A phrase counted in vain
has an infrequent subphrase and can't reach the threshold. Counts are therefore
exact; phrases are told apart by their text, not by hash.

Before the first step the texts are encoded once, as blocks of word numbers with
their words, and hashed counters of all words and pairs are summed over all blocks
in a table of fixed size. A word or pair whose counter stays below the threshold
can't reach it and isn't counted at all. A second table does the same for the runs of
three to five words whose pairs all may reach it. This changes cost only.

A task adds up its blocks before it sends counts, and its hashed counters travel
compressed, so what is shuffled follows the phrases and the tasks (``TASK_WORDS``
words each), not the blocks.

The state (one row per counted phrase) is a distributed table; levels whose cycle
is complete are cut down to their frequent phrases. The driver gets a bitmap of
fixed size per step.

Null texts are empty; a null language is ``und``; repeated rows count each time;
other columns are not read. Languages without a candidate return no row.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsignals.llm.common import buckets, ship_package, small_side, stage
from recsignals.llm.textbuf import U64, give_back, gram_hashes, mix
from recsignals.session import drop_path, run_folder, write_stage

#: Shards of the cycle; text bytes of a block; words a task counts at least; counts it holds before it sends them.
SHARDS, BLOCK_BYTES, TASK_WORDS, HELD_COUNTS = 3, 8 << 20, 8_000_000, 600_000
#: Least and most bits of the table of active phrases (a byte each) and of the table of hashed counters (a bit each, a byte inside a task).
SLOT_BITS, COUNTER_BITS = (16, 25), (16, 27)
LONGEST = 5
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz\n\n\n\n\n\n\n\n\n ")
_STATE = "lang", "phrase", "k"


class _Words(dict):
    """Words of a block -> numbers; a line break, which no phrase crosses, is 0."""

    def __init__(self):
        super().__init__({b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def numbered(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Word numbers of the texts in order, 0 between pieces, and the words by number."""
    words = _Words()
    split = b"\n".join(texts).translate(_LOWER).replace(b"\n", b" \n ").split(b" ")
    at = np.array([words[w] for w in split if w] + [0], np.int32)
    return at, list(words)


def encoded(rows: DataFrame, shards: int) -> DataFrame:
    """Blocks of numbered words: lang, ids (packed), words (joined by spaces), n (words), shard."""
    names = ["lang", "ids", "words", "n", "shard"]

    def run(batches):
        held: dict[str, list[bytes]] = {}
        size, turn = 0, TaskContext.get().partitionId()

        def flush():
            nonlocal turn
            for lang, texts in held.items():
                at, words = numbered(texts)
                cols = [pa.array([x], t) for x, t in ((lang, pa.string()), (at.tobytes(), pa.binary()), (b" ".join(words), pa.binary()), (int((at > 0).sum()), pa.int64()), (turn % shards, pa.int32()))]
                yield pa.RecordBatch.from_arrays(cols, names=names)
                turn += 1
            held.clear()
            give_back()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                raw = text.as_py().encode()
                held.setdefault(lang, []).append(raw)
                size += len(raw)
                if size > BLOCK_BYTES:
                    yield from flush()
                    size = 0
        yield from flush()

    return rows.mapInArrow(run, "lang string, ids binary, words binary, n long, shard int")


def language_seed(lang: str) -> np.uint64:
    return U64(xxhash.xxh64_intdigest(lang.encode(), 1) | 1)


class Block:
    """A block of one language: its word numbers, words and the words' hashes."""

    def __init__(self, lang: str, ids: bytes, words: bytes):
        self.at, self.words = np.frombuffer(ids, np.int32), words.split(b" ")
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words), U64, len(self.words)) + language_seed(lang)
        self.place = np.flatnonzero(self.at)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Places that begin a pair of words, and the pairs' hashes."""
        both = self.place[:-1][np.diff(self.place) == 1]
        return both, pair_hashes(self.hashes, self.at[both], self.at[both + 1])


def pair_hashes(hashes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = hashes * U64(0x9E3779B97F4A7C15)
    return mix(h[left] + hashes[right])


def _blocks(batches):
    for batch in batches:
        for lang, ids, words in zip(*(batch.column(c) for c in ("lang", "ids", "words"))):
            yield lang.as_py(), Block(lang.as_py(), ids.as_py(), words.as_py())


def short_grams(block: Block):
    """(hashes, counts) of the block's words, and of its pairs with repeats."""
    yield mix(block.hashes), np.bincount(block.at[block.place], minlength=len(block.words))
    yield block.pairs()[1], None


def long_grams(block: Block, flags: np.ndarray):
    """(hashes, None) of the runs of three to five words, with repeats, all of whose pairs are flagged."""
    both, h = block.pairs()
    pair, words = np.zeros(len(block.at), bool), block.hashes[block.at]
    pair[both[_flag(flags, h, (8 * len(flags) - 1).bit_length())]] = True
    run = pair
    for k in range(3, LONGEST + 1):
        run = run[:-1] & pair[k - 2 :]
        yield gram_hashes(words, k)[np.flatnonzero(run)], None


def zipped(a: np.ndarray) -> bytes:
    return pa.Codec("zstd", compression_level=1).compress(a.tobytes(), asbytes=True)


def unzipped(cell: bytes, n: int, kind) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(cell, decompressed_size=n * np.dtype(kind).itemsize, asbytes=True), kind)


def possible_slots(blocks: DataFrame, bits: int, least: int, grams) -> bytes:
    """Packed flags of the slots in which the ``grams`` of all blocks together occur ``least`` times or more.

    A task counts in a table of fixed size; tables are added slice by slice."""
    slices = min(64, 1 << (bits - 6))
    width, kind = (1 << bits) // slices, np.uint8 if least < 256 else np.uint32

    def count(batches):
        total, seen = np.zeros(1 << bits, kind), False
        for _, block in _blocks(batches):
            seen = True
            for h, n in grams(block):
                slot, first = np.unique(h >> U64(64 - bits), return_inverse=True)
                n = np.bincount(first, n) + total[slot]
                total[slot] = np.minimum(n, least).astype(kind)
        if seen:
            for i, own in enumerate(total.reshape(slices, width)):
                at = np.flatnonzero(own).astype(np.int32)
                dense = 8 * len(at) > width
                # Steps between the slots in use are small numbers.
                steps, n = (None, width) if dense else (zipped(np.diff(at, prepend=np.int32(0))), len(at))
                cols = [pa.array([i], pa.int32()), pa.array([n], pa.int32()), pa.array([steps], pa.binary()), pa.array([zipped(own if dense else own[at])], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["slice", "n", "at", "counts"])
        give_back()

    def add(key: tuple[pa.Scalar, ...], tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for table in tables:
            for n, at, counts in zip(table.column("n").to_pylist(), table.column("at"), table.column("counts")):
                own = unzipped(counts.as_py(), n, kind)
                if at.is_valid:
                    total[np.cumsum(unzipped(at.as_py(), n, np.int32))] += own
                else:
                    total += own
        cols = [pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(total >= least).tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, names=["slice", "flags"])

    parts = blocks.mapInArrow(count, "slice int, n int, at binary, counts binary")
    out = np.zeros((slices, width // 8), np.uint8)
    for r in parts.groupBy("slice").applyInArrow(add, "slice int, flags binary").collect():
        out[r["slice"]] = np.frombuffer(r["flags"], np.uint8)
    return out.tobytes()


def _flag(flags: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    slot = h >> U64(64 - bits)
    return (flags[(slot >> U64(3)).astype(np.int64)] >> (7 - (slot & U64(7))).astype(np.uint8)) & 1 == 1


def block_counts(block: Block, tags: np.ndarray, flags: np.ndarray, longer: np.ndarray, step: int, shards: int):
    """(phrases, k, counts) of one block: words in the first cycle, longer phrases while they are active."""
    at, hashes = block.at, block.hashes
    text = pa.array([w.decode("utf-8") for w in block.words], pa.string())
    slots, bits = U64(64 - (len(tags) - 1).bit_length()), (8 * len(flags) - 1).bit_length()
    own = mix(hashes)
    if step <= shards:
        n = np.bincount(at[block.place], minlength=len(hashes))
        keep = _flag(flags, own, bits)
        keep[0] = False
        names = pa.concat_arrays([pa.array([""]), text.filter(pa.array(keep))])
        k = np.ones(len(names), int)
        k[0] = 0
        yield names, k, np.concatenate([[n.sum()], n[keep]])
    # Per place: the number of the k-gram that begins there, and the step in which it became frequent (0: not yet).
    place, gram = block.place, at[block.place].astype(np.int64)
    tag = tags[own >> slots][gram]
    for k in range(2, LONGEST + 1):
        live = tag > 0
        place, gram, tag = place[live], gram[live], tag[live]
        if len(place) < 2:
            return
        both = np.flatnonzero(place[1:] == place[:-1] + 1)
        if k == 2:
            both = both[_flag(flags, pair_hashes(hashes, gram[both], gram[both + 1]), bits)]
        since = np.maximum(tag[both], tag[both + 1])
        place = place[both]
        code, first, gram, n = np.unique(gram[both] * len(hashes) + at[place + k - 1], return_index=True, return_inverse=True, return_counts=True)
        if not len(code):
            return
        parts = [at[place[first] + j] for j in range(k)]
        h = gram_hashes(hashes[np.stack(parts, 1).ravel()], k)[::k]
        active = since[first].astype(np.int64) >= step - shards
        if k > 2:
            active &= _flag(longer, h, (8 * len(longer) - 1).bit_length())
        if active.any():
            names = pc.binary_join_element_wise(*[text.take(pa.array(p[active])) for p in parts], " ")
            yield names, np.full(len(names), k), n[active]
        tag = tags[h >> slots][gram]


def scan(shard: DataFrame, tags, flags, longer, step: int, shards: int) -> DataFrame:
    """Counts of the active phrases in one shard, added up in each task: lang, phrase, k, c."""

    def added(held: list[pa.Table]) -> pa.Table:
        out = pa.concat_tables(held).group_by(list(_STATE), use_threads=False).aggregate([("c", "sum")])
        return pa.table([out.column(c) for c in (*_STATE, "c_sum")], names=[*_STATE, "c"])

    def run(batches):
        possible, possible_longer = (np.frombuffer(f.value, np.uint8) for f in (flags, longer))
        held, rows = [], 0
        for lang, block in _blocks(batches):
            for phrase, k, n in block_counts(block, tags.value, possible, possible_longer, step, shards):
                held.append(pa.table([pa.repeat(lang, len(phrase)), phrase, pa.array(k.astype(np.int32)), pa.array(n.astype(np.int64))], names=[*_STATE, "c"]))
                rows += len(phrase)
            if rows > HELD_COUNTS:
                held = [added(held)]
                rows = held[0].num_rows
                if 2 * rows > HELD_COUNTS:  # mostly different phrases
                    yield from held[0].to_batches(max_chunksize=50_000)
                    held, rows = [], 0
        if held:
            yield from added(held).to_batches(max_chunksize=50_000)
        del held
        give_back()

    return shard.select("lang", "ids", "words").mapInArrow(run, "lang string, phrase string, k int, c long")


def fresh_slots(state: DataFrame, step: int, bits: int) -> np.ndarray:
    """Slots of the phrases that became frequent in this step, through bitmaps of fixed size."""
    slices = min(64, 1 << (bits - 6))
    width = (1 << bits) // slices

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        bitmap = np.zeros(width, bool)
        bitmap[pdf["slot"].to_numpy() % width] = True
        return pd.DataFrame({"slice": [int(pdf["slot"].iloc[0]) // width], "bits": [np.packbits(bitmap).tobytes()]})

    def slots(batches):
        for batch in batches:
            own = [np.array([xxhash.xxh64_intdigest(w) for w in phrase.encode().split(b" ")], U64) + language_seed(lang) for lang, phrase in zip(*(batch.column(c).to_pylist() for c in ("lang", "phrase")))]
            found = [gram_hashes(words, len(words)) >> U64(64 - bits) for words in own]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)).astype(np.int64) if found else [], pa.int64())], names=["slot"])

    rows = state.filter(F.col("tag") == step).select("lang", "phrase").mapInArrow(slots, "slot long").distinct()
    out = np.zeros((slices, width), bool)
    for r in rows.groupBy(F.expr(f"slot div {width}")).applyInPandas(pack, "slice int, bits binary").collect():
        out[r["slice"]] = np.unpackbits(np.frombuffer(r["bits"], np.uint8))[:width].astype(bool)
    return np.flatnonzero(out.ravel())


def phrase_counts(docs: DataFrame, lang_col="lang", text_col="text", least=100, shards=SHARDS) -> DataFrame:
    """(lang, phrase, k, n): exact counts of all words and phrases of up to five words that occur ``least`` times or more in
    their language; k = 0 with an empty phrase counts all words of the language."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), docs[text_col].cast("string").alias("text")).filter("text <> ''")
    path = f"{run_folder(spark)}/op12-shards-{uuid.uuid4().hex}"
    encoded(rows, shards).write.partitionBy("shard").parquet(path)
    shard_of = spark.read.schema("lang string, ids binary, words binary, n long, shard int").parquet(path)
    words = shard_of.agg(F.sum("n")).first()[0] or 0
    size = lambda slots, limit: min(max(math.ceil(math.log2(1 + slots)), limit[0]), limit[1])
    bits = size(words / least, SLOT_BITS)
    counters = size(6 * words / least, COUNTER_BITS)
    tasks = buckets(words, TASK_WORDS)
    flags = spark.sparkContext.broadcast(possible_slots(shard_of.coalesce(tasks), counters, least, short_grams))
    longer = spark.sparkContext.broadcast(possible_slots(shard_of.coalesce(tasks), counters, least, lambda block: long_grams(block, np.frombuffer(flags.value, np.uint8))))

    tags = np.zeros(1 << bits, np.uint8)
    state_path, state, step, fresh_at = None, None, 0, {}
    while True:
        step += 1
        sent, bit = spark.sparkContext.broadcast(tags), 1 << ((step - 1) % shards)
        counted = scan(shard_of.filter(F.col("shard") == (step - 1) % shards).coalesce(buckets(words / shards, TASK_WORDS, 6)), sent, flags, longer, step, shards)
        counted = counted.select(*_STATE, F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("mask"), F.lit(0).alias("tag"), "c")
        if state is not None:
            counted = counted.unionByName(state.withColumn("c", F.lit(0).cast("long")))
        merged = counted.groupBy(*_STATE).agg(F.sum("n").alias("n"), F.max("mask").alias("mask"), F.max("tag").alias("tag"), F.sum("c").alias("c"))
        seen = F.col("mask").bitwiseAND(F.lit(bit)) != 0
        total = F.when(seen, F.col("n")).otherwise(F.col("n") + F.col("c"))
        # Level k is complete when no subphrase became frequent in the last cycle: only frequent phrases stay.
        ripe = []
        for k in range(1, LONGEST + 1):
            if fresh_at.get(k - 1, 0) > step - shards or step < shards:
                break
            ripe.append(k)
        merged = merged.select(*_STATE, total.alias("n"), F.when(F.col("c") > 0, F.col("mask").bitwiseOR(F.lit(bit))).otherwise(F.col("mask")).alias("mask"), "tag")
        reached = (F.col("tag") == 0) & (F.col("n") >= least) & F.col("k").between(1, LONGEST)
        merged = merged.withColumn("tag", F.when(reached, F.lit(step)).otherwise(F.col("tag")))
        if ripe:
            merged = merged.filter((F.col("n") >= least) | ~F.col("k").isin(ripe))
        new_path = write_stage(merged, "op12-state")
        if state_path:
            drop_path(spark, state_path)
        sent.unpersist()
        state_path, state = new_path, spark.read.parquet(new_path)
        for r in state.filter(F.col("tag") == step).groupBy("k").count().collect():
            fresh_at[r["k"]] = step
        # A phrase that became frequent at length 5 activates nothing.
        if step >= shards and max((s for k, s in fresh_at.items() if k < LONGEST), default=0) <= step - shards:
            break
        tags[fresh_slots(state.filter(F.col("k") < LONGEST), step, bits)] = step
    flags.unpersist()
    longer.unpersist()
    drop_path(spark, path)
    return state.filter((F.col("n") >= least) | (F.col("k") == 0)).select("lang", "phrase", "k", "n")


def collocations(docs: DataFrame, lang_col="lang", text_col="text", least=100, top=2000, shards=SHARDS) -> DataFrame:
    """The ``top`` phrases of each language by their weakest cut: lang, rank, phrase, a, l, r, n, score."""
    counts = stage(phrase_counts(docs, lang_col, text_col, least, shards), "op12-counts")
    words = small_side(stage(counts.filter("k = 0").select("lang", F.col("n").alias("n_words")), "op12-words"), 64)
    cands = counts.filter("k >= 2").select("lang", "phrase", "k", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))

    # Phrases inside a longer candidate that occurs as often.
    pieces = cands.filter("k >= 3").select("lang", "a", "w", F.explode(F.expr("sequence(2, k - 1)")).alias("m"))
    pieces = pieces.select("lang", "a", F.explode(F.expr("transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))")).alias("phrase"))
    inside = pieces.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = stage(cands.join(inside, ["lang", "phrase"], "left").filter("longer IS NULL OR longer < a").select("lang", "phrase", "a", "w"), "op12-kept")

    cuts = kept.select("lang", "phrase", "a", "w", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", F.expr("array_join(slice(w, 1, cut), ' ')").alias("first"), F.expr("array_join(slice(w, cut + 1, size(w) - cut), ' ')").alias("rest"))
    known = small_side(stage(counts.filter("k BETWEEN 1 AND 4").select("lang", "phrase", "n"), "op12-parts"), 96)
    part = lambda name, n: known.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    scored = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(words, "lang")
    score = F.expr("cast(cast(a * 1000 as decimal(20,0)) * cast(n_words as decimal(18,0)) as decimal(38,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    weakest = scored.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r")).alias("s"), F.first("a").alias("a"), F.first("n_words").alias("n"))
    weakest = weakest.select("lang", "phrase", "a", "s.l", "s.r", "n", "s.score")

    # A language may hold most phrases: its first ones are found per salted part, then among those.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salts = buckets(kept.count(), 50_000, 1)
    ranked = weakest.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", *[F.col(c).cast("long") for c in ("a", "l", "r", "n", "score")])
