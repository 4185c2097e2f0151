"""Compression of vectors into short codes: one codebook entry per part, learnt by exact integer rounds.

Method. A vector's components become integers and its equal consecutive parts go,
each for itself, into blocks of neighbours: per part position, rows are sorted by
their place on a Hilbert curve through the part's space (range shuffle, ties broken
by row, so a vector that a third of the rows share is spread) and cut into flat
blocks. A block stores its values, their box (least and largest value per
component), count and sums. In every round the distances between box and codebook
entries leave a shortlist: the entries whose least distance to the box is not above
the smallest largest distance of any. One entry left takes the whole block by its
stored sums; else a kernel of exact integer distances decides among the shortlist
(ties to the lower entry). Tasks return sums and counts per entry, so the driver
gets parts x entries rows per round, whatever the input.

Exactness. Components are kept within +-2**40 (values of 2**28 and more saturate).
Kernels compute in 64 bits where the box and the codebook rule out an overflow, in
Python's integers elsewhere; sums are decimals of 38 digits. An error beyond 64
bits is returned as the largest long.

Rows whose vector is null, or holds null or non-finite components, are dropped; so
are empty vectors and those of another length than the most frequent one (of equal
ones the smallest; lengths that the parts don't divide don't count). Codebooks
start from the smallest ids, among repeated ids in the order of their components;
null ids come last. With fewer kept rows than entries, codebooks are as long as
there are rows. Repeated rows each get a row; null labels form one group; other
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsignals.llm.common import buckets, ship_package, small_side, stage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Rows of a block, least components of one sorting task, and the bound of a component.
BLOCK_ROWS, TASK_VALUES, LIMIT = 256, 4_000_000, 1 << 40
_LONG = (1 << 63) - 1


def hilbert_keys(x: np.ndarray, low: float, high: float) -> np.ndarray:
    """Place of each row (n x d) on a Hilbert curve through the cube [low, high]**d, as a 64-bit number."""
    n, d = x.shape
    bits = max(1, min(16, 63 // d))
    used = min(d, 63)  # further components don't take part in the order
    cell = np.clip((x[:, :used].astype(np.float64) - low) / max(high - low, 1) * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
    at = [cell[:, j].copy() for j in range(used)]
    # Coordinates to the curve's transposed index: undo the excess rotations level by level, then Gray code.
    q = 1 << (bits - 1)
    while q > 1:
        for j in range(used):
            up = (at[j] & q) != 0
            swap = np.where(up, 0, (at[0] ^ at[j]) & (q - 1))
            at[0] ^= np.where(up, q - 1, swap)
            at[j] ^= swap
        q >>= 1
    for j in range(1, used):
        at[j] ^= at[j - 1]
    turn, q = np.zeros(n, np.int64), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((at[-1] & q) != 0, q - 1, 0)
        q >>= 1
    key = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for j in range(used):
            key = key << 1 | ((at[j] ^ turn) >> b & 1)
    return key


def _array(column, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def integers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(row, vec_id, label, v): the kept rows with integer components; ``row`` is unique."""
    v = vectors[vector_col].cast("array<double>")
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), vectors[id_col].alias("vec_id"), vectors[label_col].alias("label"), v.alias("v"))
    sound = F.size("v") > 0
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    bounded = F.transform("v", lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("long"))
    return rows.filter(F.col("v").isNotNull() & sound & finite).withColumn("v", bounded)


def parts_of(rows: DataFrame, width: int, parts: int, low: float, high: float) -> DataFrame:
    """(part, key, row, v): each part of each row with its Hilbert key."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            x, row = _array(batch.column("v"), n), batch.column("row")
            for p in range(parts):
                own = np.ascontiguousarray(x[:, p * width : (p + 1) * width])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, p, np.int32)), pa.array(hilbert_keys(own, low, high)), row, pa.FixedSizeListArray.from_arrays(pa.array(own.ravel()), width).cast(pa.list_(pa.int64()))],
                    names=["part", "key", "row", "v"])

    return rows.select("row", "v").mapInArrow(run, "part int, key long, row long, v array<long>")


def flat_blocks(sorted_parts: DataFrame, width: int) -> DataFrame:
    """Blocks of sorted neighbours: part, n, low, high, sums, rows, values (packed)."""
    names = ["part", "n", "low", "high", "sums", "rows", "data"]

    def run(batches):
        for batch in batches:
            x, part, row = _array(batch.column("v"), batch.num_rows), batch.column("part").to_numpy(), batch.column("row").to_numpy()
            edge = np.unique(np.concatenate([np.arange(0, len(part), BLOCK_ROWS), np.flatnonzero(np.diff(part)) + 1, [len(part)]]))
            out = [(int(part[a]), int(z - a), x[a:z].min(0).tolist(), x[a:z].max(0).tolist(), x[a:z].sum(0).tolist(), row[a:z].tobytes(), x[a:z].tobytes()) for a, z in zip(edge[:-1], edge[1:])]
            kinds = [pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 3, pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], kinds[j]) for j in range(7)], names=names)

    return sorted_parts.mapInArrow(run, "part int, n int, low array<long>, high array<long>, sums array<long>, rows binary, data binary")


def _fits(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> bool:
    """Squared distances and sums over this range stay within 64 bits."""
    far = max(int(high.max()), int(book.max())) - min(int(low.min()), int(book.min()))
    return far * far * len(low) < _LONG


def nearest(low: np.ndarray, high: np.ndarray, values, book: np.ndarray, distances: bool) -> tuple[np.ndarray | int, np.ndarray | None]:
    """Entry of each row of a block (one number if all rows share it without a look at them), and its squared distance if asked.

    ``values`` gives the rows; it is called only if they are needed.
    """
    kind = np.int64 if _fits(low, high, book) else object
    low, high, book = low.astype(kind), high.astype(kind), book.astype(kind)
    off = np.maximum(np.maximum(low - book, book - high), 0)
    far = np.maximum(abs(low - book), abs(high - book))
    near, most = (off * off).sum(1), (far * far).sum(1)
    short = np.flatnonzero(near <= most.min())
    if len(short) == 1 and not distances:
        return int(short[0]), None
    x = values().astype(kind)
    each = np.stack([((x - book[e]) ** 2).sum(1) for e in short], 1)
    best = each.argmin(1)
    return short[best], each[np.arange(len(x)), best] if distances else None


def _block(row: dict, width: int):
    return (np.array(row["low"]), np.array(row["high"]), lambda: np.frombuffer(row["data"], np.int64).reshape(-1, width))


def round_sums(blocks: DataFrame, books, width: int) -> list:
    """(part, entry, sums, n) of one round: what each entry's nearest parts add up to."""

    def run(batches):
        held: dict[tuple[int, int], list] = {}

        def add(part: int, entry: int, sums: list[int], n: int) -> None:
            old = held.setdefault((part, entry), [[0] * width, 0])
            old[0] = [a + b for a, b in zip(old[0], sums)]
            old[1] += n

        for batch in batches:
            for row in batch.to_pylist():
                low, high, values = _block(row, width)
                entry, _ = nearest(low, high, values, books.value[row["part"]], False)
                if isinstance(entry, int):
                    add(row["part"], entry, row["sums"], row["n"])
                    continue
                x = values()
                for e in np.unique(entry):
                    own = x[entry == e]
                    add(row["part"], int(e), own.sum(0).tolist(), len(own))
        flat = [(p, e, i, str(s), n) for (p, e), (sums, n) in held.items() for i, s in enumerate(sums)]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in flat], kinds[j]) for j in range(5)], names=["part", "entry", "i", "s", "n"])

    found = blocks.select("part", "n", "low", "high", "sums", "data").mapInArrow(run, "part int, entry int, i int, s string, n long")
    return found.groupBy("part", "entry", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect()


def assigned(blocks: DataFrame, books, width: int) -> DataFrame:
    """(row, part, entry, d): the final entry of every part and its squared distance."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                entry, d = nearest(*_block(row, width), books.value[row["part"]], True)
                d = pa.array(d) if d.dtype != object else pa.array([min(int(x), _LONG) for x in d], pa.int64())
                n = row["n"]
                cols = [pa.array(np.frombuffer(row["rows"], np.int64)), pa.array(np.full(n, row["part"], np.int32)), pa.array(np.asarray(entry, np.int32)), d]
                yield pa.RecordBatch.from_arrays(cols, names=["row", "part", "entry", "d"])

    return blocks.mapInArrow(run, "row long, part int, entry int, d long")


def compress(vectors: DataFrame, id_col="vec_id", vector_col="embedding", label_col="label", parts=PARTS, entries=ENTRIES, rounds=ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(rows, codebooks): row, id, label, entries (one per part) and error of every kept row; one array of entries per part."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = stage(integers(vectors, id_col, vector_col, label_col), "op11-rows")  # row numbers are fixed from here on
    shape = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high")).filter(F.col("d") % parts == 0).orderBy(F.desc("n"), "d").first()
    empty = f"row long, `{id_col}` {rows.schema['vec_id'].dataType.simpleString()}, `{label_col}` {rows.schema['label'].dataType.simpleString()}, entries array<int>, error long"
    if shape is None:
        return spark.createDataFrame([], empty), []
    width = shape["d"] // parts
    rows = rows.filter(F.size("v") == shape["d"])
    tasks = buckets(shape["n"] * shape["d"], TASK_VALUES)
    split = parts_of(rows, width, parts, float(shape["low"]), float(shape["high"]))
    split = split.repartitionByRange(tasks, "part", "key", "row").sortWithinPartitions("part", "key", "row")
    blocks = stage(flat_blocks(split, width), "op11-blocks")

    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    books = [np.array([r["v"][p * width : (p + 1) * width] for r in first], np.int64) for p in range(parts)]
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(books)
        books = [b.copy() for b in books]
        for r in round_sums(blocks, sent, width):
            books[r["part"]][r["entry"], r["i"]] = int(r["s"]) // r["n"]
        sent.unpersist()
    sent = spark.sparkContext.broadcast(books)
    per_row = assigned(blocks, sent, width).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("part", "entry"))).alias("e"), F.sum(F.col("d").cast("decimal(38,0)")).alias("d"))
    per_row = per_row.select("row", F.col("e.entry").alias("entries"), F.least(F.col("d"), F.lit(_LONG).cast("decimal(38,0)")).cast("long").alias("error"))
    named = rows.select("row", F.col("vec_id").alias(id_col), F.col("label").alias(label_col))
    return named.join(per_row, "row").select("row", id_col, label_col, "entries", "error"), books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def codes(vectors: DataFrame, id_col="vec_id", vector_col="embedding", label_col="label") -> DataFrame:
    """id, code (two hex digits per part), error, label_error (over rows of equal label) and the codebooks' digest."""
    rows, books = compress(vectors, id_col, vector_col, label_col)
    rows = stage(rows, "op11-codes")
    code = F.array_join(F.transform("entries", lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "")
    per = rows.groupBy(F.col(label_col).alias("l")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    per = small_side(stage(per.select("l", F.least("total", F.lit(_LONG).cast("decimal(38,0)")).cast("long").alias("label_error")), "op11-labels"), 64)
    joined = rows.join(per, rows[label_col].eqNullSafe(per["l"]), "left")
    return joined.select(id_col, code.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
