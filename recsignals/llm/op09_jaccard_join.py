"""Exact Jaccard self-join of whole texts on word shingles, and its components.

Method. Texts become sets of hashed shingles; equal sets are one node. A node's
prefix is the smallest part of its set that any partner must share a shingle
with (|x| - ceil(t|x|) + 1 of them, in one global order). Nodes that share a
prefix shingle meet in a tile; sorted by set size, only bands within the
threshold's ratio are compared. Each node has a bitmap of one to two bits per
shingle, toggled by each; unequal bits are at most unequal shingles, so a bit
count bounds the overlap from above. So does the place of the first shared
shingle: what is shared stands behind it in both. Pairs that pass are decided
exactly by intersecting the sorted arrays of both whole texts.

Order. Frequent shingles come last, told by a table of hashed counters of fixed
size over all texts. So a passage that a third of the corpus shares is in no
prefix, unless a text is little else. The order changes cost, not results.

No pair is lost and no group is expanded: first, per tile and band, each node
is tried against one pivot (its most frequent). Then rounds take the pairs that
still join different components: the ``k`` closest of every component. What a
round holds back is looked at again with k grown eightfold, among the components
concerned only, until nothing is held back. Pairs inside a component need no
test, as they change nothing. Tiles of frequent shingles are spread over salted
tasks; texts that a decision needs are fetched by id, by broadcast of the ids
only if these are few.

Null text, or text without words, has an empty set and is linked with nothing; a
shorter text than a shingle is one shingle; null ids take part but are never a
component's id (null if it has no other). Repeated rows each get a row. Extra
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsignals.llm.common import NULL_ID, buckets, few, id_back, keyed, small_side, stage, without
from recsignals.llm.graph import components
from recsignals.llm.textbuf import U64, PrefixHash, ascii_lower, blocks, give_back, gram_hashes, mix, segments, word_spans, word_table

WORD_BYTES = ~word_table((0x20, 0x20), (0x09, 0x0D))
#: Counters for frequent shingles (fixed), as 2**bits in slices.
COUNTER_BITS, SLICES = 20, 64
#: Prefix entries per task, nodes of one tile per task, members verified beside one pivot.
BUCKET_KEYS, TILE_ROWS, PIVOT_ROWS = 400_000, 20_000, 200
#: Bytes of entries with their bitmaps per group of tiles; texts that a task verifies at least.
GROUP_BYTES, VERIFY_TEXTS = 12 << 20, 2_000


def shingle_sets(buf, off, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    buf = ascii_lower(buf)
    start, end, first = word_spans(buf, off, WORD_BYTES)
    h = PrefixHash(buf).ranges(start, end)
    g = gram_hashes(h, words)
    out = []
    for a, z in zip(first[:-1].tolist(), first[1:].tolist()):
        if z - a >= words:
            x = np.sort(g[a : z - words + 1])
            out.append(x[np.concatenate(([True], x[1:] != x[:-1]))])
        else:
            out.append(gram_hashes(h[a:z], z - a) if z > a else g[:0])
    return out


def node_of(x: np.ndarray) -> int:
    """Identity of a set."""
    return int(mix(np.add.reduce(mix(x + U64(0x632BE59BD9B4E019)), keepdims=True) + U64(len(x)))[0].astype(np.int64))


def bitmap(x: np.ndarray) -> bytes:
    """One bit toggled per shingle; one to two times as many bits as shingles, a power of two, 64 at least."""
    width = max(64, 1 << (len(x) - 1).bit_length())
    odd = np.bincount((x >> U64(20)).astype(np.int64) & (width - 1), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def prefix(x: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The set's first |x| - ceil(t|x|) + 1 shingles, rare ones first."""
    p = len(x) - -(-percent * len(x) // 100) + 1
    hot = frequent[x >> U64(64 - COUNTER_BITS)]
    rare = x[~hot]
    return rare[:p] if len(rare) >= p else np.concatenate([rare, x[hot][: p - len(rare)]])


# ---- signatures and frequent shingles ------------------------------------------------


def signatures(rows: DataFrame, words: int) -> DataFrame:
    """Per text: kid, th, n, node, bits; and per task the counters, as rows with a slice number."""
    schema = "kid long, th long, n long, node long, bits binary, slice int, counts binary"
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        counts, seen = np.zeros(1 << COUNTER_BITS, np.int32), set()
        for batch, buf, off in blocks(batches, "text"):
            sets = shingle_sets(buf, off, words)
            nodes = [node_of(x) if len(x) else None for x in sets]
            fresh = [x for x, node in zip(sets, nodes) if len(x) and not (node in seen or seen.add(node))]
            if fresh:
                counts += np.bincount((np.concatenate(fresh) >> U64(64 - COUNTER_BITS)).astype(np.int64), minlength=len(counts)).astype(np.int32)
            n = batch.num_rows
            cols = [batch.column("kid"), batch.column("th"), [len(x) for x in sets], nodes, [bitmap(x) if len(x) else None for x in sets], [None] * n, [None] * n]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, kinds)], names=names)
        if seen:
            cut = counts.reshape(SLICES, -1)
            cols = [[None] * SLICES] * 5 + [range(SLICES), [c.tobytes() for c in cut]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    return rows.select("kid", "th", "text").mapInArrow(run, schema)


def frequent_table(signed: DataFrame) -> np.ndarray:
    """Flags of the counters that mark a shingle as frequent: a fixed number of bits, whatever the input."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << COUNTER_BITS) // SLICES, np.int64)
        for c in pdf["counts"]:
            total += np.frombuffer(c, np.int32)
        return pd.DataFrame({"slice": [int(pdf["slice"].iloc[0])], "counts": [total.tobytes()]})

    n = signed.filter("node is not null").count()
    total = np.zeros((SLICES, (1 << COUNTER_BITS) // SLICES), np.int64)
    for r in signed.filter("slice is not null").select("slice", "counts").groupBy("slice").applyInPandas(add, "slice int, counts binary").coalesce(SLICES // 4).collect():
        total[r["slice"]] = np.frombuffer(r["counts"], np.int64)
    total = total.ravel()
    return total >= max(64, n // 1000, 4 * int(total.mean()))


# ---- tiles -----------------------------------------------------------------------------


def prefix_rows(rows: DataFrame, frequent, words: int, percent: int, parts: int, salts: int) -> DataFrame:
    """(bucket, keys, nodes, sizes, places): packed prefix entries of all nodes, each node once per task."""

    def run(batches):
        hot, seen = frequent.value, set()
        keys, nodes, sizes, held = [], [], [], 0

        def flush():
            k = np.concatenate(keys)
            lens = np.array([len(x) for x in keys])
            kind = np.uint16 if max(sizes) < 1 << 16 else np.int32  # told apart by the cells' lengths
            node, size = np.repeat(np.array(nodes, np.int64), lens), np.repeat(np.array(sizes, kind), lens)
            place = segments(np.zeros(len(lens), np.int64), lens).astype(kind)
            salt = np.where(hot[k >> U64(64 - COUNTER_BITS)], node.view(U64) % U64(salts), U64(0))
            bucket = (mix(k + salt * U64(0x9E3779B97F4A7C15)) % U64(parts)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            edge = np.searchsorted(bucket[order], np.arange(parts + 1))
            k, node, size, place = k[order], node[order], size[order], place[order]
            full = [b for b in range(parts) if edge[b + 1] > edge[b]]
            cols = [[a[edge[b] : edge[b + 1]].tobytes() for b in full] for a in (k, node, size, place)]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *[pa.array(c, pa.binary()) for c in cols]], names=["bucket", "keys", "nodes", "sizes", "places"])

        for _, buf, off in blocks(batches, "text"):
            for x in shingle_sets(buf, off, words):
                if len(x) and (node := node_of(x)) not in seen:
                    seen.add(node)
                    keys.append(prefix(x, hot, percent))
                    nodes.append(node)
                    sizes.append(len(x))
                    held += len(keys[-1])
            if held > 2 * BUCKET_KEYS:
                yield flush()
                keys, nodes, sizes, held = [], [], [], 0
        if keys:
            yield flush()
        keys.clear()
        give_back()

    return rows.select("text").mapInArrow(run, "bucket int, keys binary, nodes binary, sizes binary, places binary")


def numbers(packed: bytes, n: int) -> np.ndarray:
    """n numbers, packed with two or four bytes each."""
    return np.frombuffer(packed, np.uint16 if len(packed) == 2 * n else np.int32).astype(np.int32)


def tiles(packed: DataFrame, percent: int, keep_all: bool) -> DataFrame:
    """Entries of shared prefix shingles (key, node, size, place), and star pairs (pivot, node, shared) per size band."""

    def run(table: pa.Table) -> pa.Table:
        key, node = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.int64) for c in ("keys", "nodes"))
        size, place = (np.concatenate([numbers(x, len(k) // 8) for k, x in zip(table.column("keys").to_pylist(), table.column(c).to_pylist())]) for c in ("sizes", "places"))
        order = np.lexsort((node, size, key))
        key, node, size, place = key[order], node[order], size[order].astype(np.int64), place[order].astype(np.int64)
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node, size, place = key[new], node[new], size[new], place[new]
        if not keep_all:  # salted tiles: the rest of a tile may be elsewhere
            # Partners have at least the ratio's share of the size; at most as many as the shingles from here on can outweigh.
            number = np.cumsum(np.concatenate(([0], key[1:] != key[:-1]))) << 32
            least, most = -(-percent * size // 100), (100 + percent) * (size - place) // percent - size
            found = np.searchsorted(number + size, number + np.maximum(most, 0), side="right") - np.searchsorted(number + size, number + least)
            kept = found > (most >= size)
            key, node, size, place = key[kept], node[kept], size[kept], place[kept]
        # Bands: within a tile, from one size up to the largest within the ratio.
        pivot, i = node.copy(), 0
        edge = np.append(np.flatnonzero(np.diff(key, prepend=key[:1] ^ 1)), len(key))
        end_of = np.repeat(edge[1:], np.diff(edge))
        while i < len(key):
            z = i + int(np.searchsorted(size[i : end_of[i]], 100 * size[i] // percent, side="right"))
            pivot[i:z] = node[i:z].min()
            i = z
        star = pivot != node
        pairs, shared = np.unique(np.stack([pivot[star], node[star]], 1), axis=0, return_counts=True)
        names = ["key", "node", "size", "place", "pivot", "shared"]
        entries = pa.table([pa.array(x) for x in (key, node, size, place)] + [pa.nulls(len(key), pa.int64())] * 2, names=names)
        none = pa.nulls(len(pairs), pa.int64())
        stars = pa.table([none, pa.array(pairs[:, 1]), none, none, pa.array(pairs[:, 0]), pa.array(shared, pa.int64())], names=names)
        give_back()
        return pa.concat_tables([entries, stars])

    return packed.groupBy("bucket").applyInArrow(run, "key long, node long, size long, place long, pivot long, shared long")


class Bitmaps:
    """Bitmaps of many nodes by width, for bit counts over pairs of row numbers."""

    def __init__(self, bits: list[bytes]):
        width = np.array([len(b) for b in bits], np.int64)
        self.width, self.at, self.rows = width, np.zeros(len(bits), np.int64), {}
        for w in np.unique(width).tolist():
            own = np.flatnonzero(width == w)
            self.at[own] = np.arange(len(own))
            self.rows[w] = np.frombuffer(b"".join([bits[x] for x in own]), np.uint8).reshape(len(own), w).view(U64)

    def unequal(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lower bound of the unequal shingles of each pair."""
        out = np.zeros(len(i), np.int64)
        code = self.width[i] << 32 | self.width[j]
        for c in np.unique(code).tolist():
            own = np.flatnonzero(code == c)
            x, y = self.rows[c >> 32][self.at[i[own]]], self.rows[c & 0xFFFFFFFF][self.at[j[own]]]
            x, y = (x, y) if x.shape[1] >= y.shape[1] else (y, x)
            while x.shape[1] > y.shape[1]:  # a wide bitmap folds to a narrow one
                x = x[:, : x.shape[1] // 2] ^ x[:, x.shape[1] // 2 :]
            out[own] = np.bitwise_count(x ^ y).sum(axis=1)
        return out


def _may_link(n: np.ndarray, m: np.ndarray, inter: np.ndarray, percent: int) -> np.ndarray:
    """An upper bound of the overlap allows a link."""
    return 100 * inter >= percent * (n + m - inter)


def cross_pairs(entries: DataFrame, percent: int, k: int) -> DataFrame:
    """entries (part, key, chunk, minor, node, size, place, comp, bits) -> (a, b, held_a, held_b): the k closest pairs of each component that may link.

    Where a task kept back further pairs of a component, held names it.
    """

    def run(table: pa.Table) -> pa.Table:
        key, chunk, size, node, place, comp, minor = (table.column(c).to_numpy() for c in ("key", "chunk", "size", "node", "place", "comp", "minor"))
        order = np.lexsort((node, size, chunk, key))
        maps = Bitmaps(table.column("bits").take(pa.array(order)).to_pylist())
        key, chunk, size, node, place, comp, minor = (x[order] for x in (key, chunk, size, node, place, comp, minor))
        tile = np.cumsum(np.concatenate(([0], (key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1]))))
        found = np.zeros((0, 3), np.int64)
        held: list[np.ndarray] = []

        def best(found: np.ndarray) -> np.ndarray:
            """The distinct pairs among the k closest of one of their components."""
            a, b = node[found[:, 0]], node[found[:, 1]]
            swap = a > b
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            by = np.lexsort((b, a))
            new = np.ones(len(by), bool)
            new[1:] = (a[by][1:] != a[by][:-1]) | (b[by][1:] != b[by][:-1])
            found = found[by[new]]
            of = np.concatenate([comp[found[:, 0]], comp[found[:, 1]]])
            by = np.lexsort((np.tile(np.arange(len(found)), 2), np.tile(found[:, 2], 2), of))
            rank = np.arange(len(by)) - np.searchsorted(of[by], of[by])
            keep = np.zeros(len(found), bool)
            keep[by[rank < k] % max(1, len(found))] = True
            held.append(np.unique(comp[found[~keep][:, :2]]))
            return found[keep]

        def judge(i: np.ndarray, j: np.ndarray) -> None:
            nonlocal found
            inter = np.minimum(size[i] - place[i], size[j] - place[j])
            ok = _may_link(size[i], size[j], inter, percent)
            i, j = i[ok], j[ok]
            e = maps.unequal(i, j)
            ok = _may_link(size[i], size[j], (size[i] + size[j] - e) // 2, percent)
            found = np.concatenate([found, np.stack([i[ok], j[ok], e[ok]], 1)])
            if len(found) > 500_000:
                found = best(found)

        todo, waiting, step, live = [], 0, 1, np.arange(len(node))
        while len(live):
            live = live[live + step < len(node)]
            live = live[(tile[live] == tile[live + step]) & (100 * size[live] >= percent * size[live + step])]
            other = live + step
            take = (comp[live] != comp[other]) & ~(minor[live] & minor[other] & (chunk[live] > 0))
            if take.any():
                todo.append((live[take], other[take]))
                waiting += int(take.sum())
                if waiting > 200_000:
                    judge(*(np.concatenate(x) for x in zip(*todo)))
                    todo, waiting = [], 0
            step += 1
        if todo:
            judge(*(np.concatenate(x) for x in zip(*todo)))
        found = best(found)
        back = np.unique(np.concatenate(held))
        c, d = comp[found[:, 0]], comp[found[:, 1]]
        cols = [pa.array(node[found[:, 0]]), pa.array(node[found[:, 1]]), pa.array(c, mask=~np.isin(c, back)), pa.array(d, mask=~np.isin(d, back))]
        give_back()
        return pa.table(cols, names=["a", "b", "held_a", "held_b"])

    return entries.groupBy("part").applyInArrow(run, "a long, b long, held_a long, held_b long")


# ---- exact decision ----------------------------------------------------------------------


def verify(pairs: DataFrame, rows: int, texts: DataFrame, holders: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by intersecting the sets of both whole texts; ``rows`` is about their number.

    holders: (node, kid, th), one text per node. Members are read beside their
    pivot ``a``; a pivot with many members is spread over salted groups.
    """
    pairs = stage(few(pairs.select("a", "b").distinct(), rows), "op9-pairs")
    rows = pairs.count()
    load = pairs.groupBy("a").agg(F.ceil(F.count("*") / PIVOT_ROWS).alias("salts"))
    salted = pairs.join(load, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")))
    wanted = salted.select("a", "salt", F.col("b").alias("node"), F.lit(0).alias("pivot")).unionByName(salted.select("a", "salt", F.col("a").alias("node"), F.lit(1).alias("pivot")).distinct())
    wanted = stage(few(wanted.join(holders, "node"), 2 * rows), "op9-wanted")
    ask = small_side(wanted, 48)
    beside = texts.join(ask, ["kid", "th"]).select("a", "salt", "pivot", "node", "text")
    spark = texts.sparkSession
    beside = beside.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "a", "salt")
    beside = few(beside, 2 * rows, VERIFY_TEXTS).sortWithinPartitions("a", "salt", F.desc("pivot"))

    def run(batches):
        own, own_set = None, None
        for batch, buf, off in blocks(batches, "text"):
            links = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("a", "salt", "pivot", "node")), shingle_sets(buf, off, words))
            for a, salt, pivot, node, x in rows:
                if pivot:
                    own, own_set = (a, salt), x
                    continue
                assert own == (a, salt)
                inter = int(np.isin(x, own_set, assume_unique=True, kind="sort").sum())
                if 100 * inter >= percent * (len(x) + len(own_set) - inter):
                    links.append((a, node))
            yield pa.RecordBatch.from_arrays([pa.array([v[0] for v in links], pa.int64()), pa.array([v[1] for v in links], pa.int64())], names=["a", "b"])

    return stage(few(beside.mapInArrow(run, "a long, b long").distinct(), rows), "op9-links")


def join(docs: DataFrame, id_col="doc_id", text_col="text", words=5, percent=75) -> tuple[DataFrame, DataFrame]:
    """(members, links): members has kid, th, n, node and component (a node); links the verified node pairs that connect them."""
    spark = docs.sparkSession
    texts = keyed(docs, id_col, text_col)
    signed = stage(signatures(texts, words), "op9-signatures")
    nodes = signed.filter("node is not null")
    frequent = spark.sparkContext.broadcast(frequent_table(signed))
    size = nodes.agg(F.sum("n").alias("n"), F.count("*").alias("rows")).first()
    parts = buckets((size["n"] or 0) * (100 - percent) / 100, BUCKET_KEYS)
    salts = 1 + size["rows"] // 5_000_000
    shared = stage(tiles(prefix_rows(texts, frequent, words, percent, parts, salts).repartition(parts, "bucket"), percent, salts > 1).coalesce(parts), "op9-tiles")
    holders = stage(few(nodes.groupBy("node").agg(F.min(F.struct("kid", "th")).alias("d"), F.first("n").alias("n"), F.first("bits").alias("bits")).select("node", "d.kid", "d.th", "n", "bits"), size["rows"], 10_000), "op9-nodes")
    about = holders.select("node", "n", "bits")

    # Each node beside the pivot that it shares most prefix shingles with.
    stars = shared.filter("pivot is not null").groupBy("node", "pivot").agg(F.sum("shared").alias("shared"))
    best = stars.groupBy("node").agg(F.max(F.struct("shared", "pivot")).alias("p")).select(F.col("p.pivot").alias("a"), F.col("node").alias("b"))
    left, right = (about.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")) for c in "ab")

    def bound(batches):
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            at = np.arange(batch.num_rows)
            unequal = Bitmaps(batch.column("bits_a").to_pylist() + batch.column("bits_b").to_pylist()).unequal(at, at + len(at))
            keep = _may_link(n, m, (n + m - unequal) // 2, percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    near = few(best.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b"), size["rows"], 10_000).mapInArrow(bound, "a long, b long")
    links = verify(near, size["rows"], texts, holders.select("node", "kid", "th"), words, percent)

    # Rounds over the pairs that still join different components.
    entries, k = shared.filter("key is not null").select("key", "node", "size", "place"), 4
    comps = stage(components(links), "op9-components")
    while True:
        rows = entries.count()
        placed = stage(few(entries.join(small_side(comps, 16), "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component"), rows), "op9-entries")
        per = placed.groupBy("key", "comp").agg(F.count("*").alias("n")).groupBy("key").agg(F.sum("n").alias("rows"), F.max(F.struct("n", "comp"))["comp"].alias("major"), F.count("*").alias("comps")).filter("comps > 1")
        chunks = F.ceil(F.col("rows") / TILE_ROWS).cast("int")
        tiled = placed.join(per, "key").withColumn("minor", F.col("comp") != F.col("major")).withColumn("chunk", F.explode(F.when(F.col("minor"), F.sequence(F.lit(0), chunks - 1)).otherwise(F.array(F.pmod(F.xxhash64("node"), chunks).cast("int")))))
        tiled = stage(few(tiled.select("key", "chunk", "minor", "node", "size", "place", "comp"), rows), "op9-open")
        # Groups are bounded in bytes, and each is a task's only one: a bitmap has up to a quarter of a byte per shingle.
        load = tiled.agg(F.sum(F.lit(64) + F.col("size") / 4)).first()[0] or 0
        spread = buckets(load, GROUP_BYTES)
        more = tiled.join(about.select("node", "bits"), "node").withColumn("part", F.pmod(F.xxhash64("key", "chunk"), F.lit(spread)))
        more = more.repartition(spread, "part")
        more = stage(cross_pairs(more, percent, k).coalesce(spread), "op9-cross")
        rows = more.count()
        found = verify(more, rows, texts, holders.select("node", "kid", "th"), words, percent)
        if not found.isEmpty():  # components change by new links only
            links = stage(links.unionByName(found), "op9-links")
            comps = stage(components(links), "op9-components")
        back = stage(few(more.select(F.explode(F.array("held_a", "held_b")).alias("comp")).filter("comp is not null").distinct(), 2 * rows), "op9-held")
        if back.isEmpty():
            break
        entries, k = placed.join(small_side(back, 8), "comp", "left_semi").select("key", "node", "size", "place"), 8 * k
    members = signed.filter("slice is null").select("kid", "th", "n", "node").join(small_side(comps, 16), "node", "left").select("kid", "th", "n", "node", F.coalesce("component", "node").alias("component"))
    return members, links


def summary(members: DataFrame, id_col="doc_id") -> DataFrame:
    """id, n_shingles and component_id (smallest id of the component) per text."""
    own = F.when(F.col("kid") != NULL_ID, F.col("kid"))
    least = members.filter("component is not null").groupBy("component").agg(F.min(own).alias("component_id"))
    # A component of one text needs no look-up.
    return members.join(small_side(stage(least, "op9-least"), 16), "component", "left").select(id_back().alias(id_col), F.col("n").alias("n_shingles"), F.coalesce(F.col("component_id"), own).alias("component_id"))


def one_of_each(docs: DataFrame, members: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """docs with one row of every component: its smallest id (null last, then text hash). Rows with empty sets all stay."""
    order = F.struct((F.col("kid") == NULL_ID).alias("none"), "kid", "th")
    linked = stage(members.filter("component is not null").select("kid", "th", "component"), "op9-members")
    keepers = linked.groupBy("component").agg(F.min(order).alias("k")).select("k.kid", "k.th")
    rejected = linked.select("kid", "th").distinct().join(keepers, ["kid", "th"], "left_anti")
    kept = without(docs, rejected.select(id_back().alias(id_col), "th"), id_col, text_col)
    # Rows that repeat a keeper's id and text: one of them stays. Only such rows are shuffled.
    again = stage(linked.groupBy("kid", "th").agg(F.count("*").alias("n")).filter("n > 1").select(id_back().alias(id_col), "th"), "op9-again")
    if again.isEmpty():
        return kept
    names = stage(again.select(F.col(id_col).alias("__id"), F.col("th").alias("__th")), "op9-again")
    same = kept[id_col].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(kept[text_col].cast("string"), F.lit(""))) == F.col("__th"))
    return without(kept, again, id_col, text_col).unionByName(kept.join(small_side(names, 32), same, "left_semi").dropDuplicates([id_col, text_col]))
