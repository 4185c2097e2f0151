"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

Terms are words and their beginnings of 4 to 8 bytes (stems, in effect), all of
those that occur in a bounded sample of the labelled rows. A text's weight for a
term is (1 + log count) * idf * (``floor`` + phi): idf counts all documents, phi (0 to 1)
is how far the term tells the labels of the sample apart, in either direction. No
term is dropped; one that tells nothing weighs ``floor``. Each example is a unit vector.
Examples, ordered by their heaviest term, fall into blocks. The ``long_lists`` most frequent
terms have the long lists; for each of them and each block the index stores the largest
weight. All other terms' lists are short and read whole. A text's bound for a block is the
largest sum of an example's short-list products in it plus the text's weights times the
long lists' largest weights. A block is read unless its bound is below the k-th largest short-list
sum, which no k-th best cosine can fall short of: the k nearest are exact. Their
distance-weighted votes, with a prior vote of the base rate, go through a logistic
curve fitted on labelled rows that are not examples (every fourth of the sample, by hash):
the score is a calibrated probability. The neighbours are the evidence.

Scale: the sample is bounded by ``max_sample`` rows and ``max_bytes`` per text (longer
texts are scored, but are no examples), so the broadcast model is bounded as well.
One map counts the sample's terms over all documents, one map scores them.

A text without any known term gets the curve's value at the base rate. Only the text is
read: never labels, language, source or id. Null text is empty. Ties between
neighbours go to the lower example number. Repeated rows each get a row; of a labelled id's
texts the least is the example. Rows with a null label or id are not used. An empty sample gives 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsignals.llm.common import id_back, keyed, stage
from recsignals.llm.textbuf import U64, PrefixHash, ascii_lower, blocks, mix, word_spans, word_table

WORD_BYTES = word_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
PREFIXES = (4, 5, 6, 7, 8)
#: Products (text x example) in memory at once.
CELLS = 1 << 20
#: Entries of short lists read at once (or one text's): each takes some 56 bytes.
HITS = 1 << 19
#: Text bytes worked on at once (or one text): a word has up to six terms, each with several arrays.
TEXT_BYTES = 1 << 18


def term_stream(buf: np.ndarray, off: np.ndarray):
    """(row of each word, hashes of its terms by kind): whole words, and beginnings of longer words."""
    buf = ascii_lower(buf)
    start, end, first = word_spans(buf, off, WORD_BYTES)
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    ph = PrefixHash(buf)
    yield row, ph.ranges(start, end)
    for n in PREFIXES:
        long = np.flatnonzero(end - start > n)
        yield row[long], mix(ph.ranges(start[long], start[long] + n) + U64(n))


def row_terms(buf: np.ndarray, off: np.ndarray):
    """Distinct (row, term hash) in row order, with counts."""
    rows, terms = zip(*term_stream(buf, off))
    row, h = np.concatenate(rows), np.concatenate(terms)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    at = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    return row[at], h[at], np.diff(np.append(at, len(h)))


def runs(starts: np.ndarray, at: np.ndarray):
    """Positions of the runs ``at`` of a list with these run starts, and the runs' lengths."""
    n = starts[at + 1] - starts[at]
    return np.repeat(starts[at] - np.cumsum(n) + n, n) + np.arange(n.sum()), n


@dataclass
class Model:
    """Terms (sorted hashes) with their weights, the examples' vectors in blocks, labels, base rate and calibration."""

    terms: np.ndarray
    weights: np.ndarray  # idf * (floor + phi)
    long: np.ndarray  # per term: its number among the long lists, or -1
    starts: np.ndarray  # per term: where its short list begins
    example: np.ndarray
    value: np.ndarray
    columns: np.ndarray  # block x example in the block x long list: weights
    highest: np.ndarray  # block x long list
    labels: np.ndarray
    names: list
    base_rate: float
    curve: tuple[float, float]
    block: int

    def __post_init__(self):
        self.flags = np.zeros(1 << 22, bool)
        self.flags[self.terms >> U64(42)] = True

    def known(self, h: np.ndarray):
        """(which hashes are terms of the model, their term numbers)."""
        may = np.flatnonzero(self.flags[h >> U64(42)])
        at = np.searchsorted(self.terms, h[may])
        at = np.minimum(at, max(0, len(self.terms) - 1))
        ok = self.terms[at] == h[may] if len(self.terms) else np.zeros(len(may), bool)
        return may[ok], at[ok]

    def found(self, buf: np.ndarray, off: np.ndarray):
        """Distinct (row, term) in row order, with counts."""
        codes, size = [], max(1, len(self.terms))
        for row, h in term_stream(buf, off):
            ok, term = self.known(h)
            codes.append(row[ok] * size + term)
        code = np.sort(np.concatenate(codes))
        at = np.flatnonzero(np.diff(code, prepend=-1))
        row, term = np.divmod(code[at], size)
        return row, term, np.diff(np.append(at, len(code)))

    def vectors(self, buf: np.ndarray, off: np.ndarray):
        """Rows' unit TF-IDF vectors: (row, term, weight) in row order."""
        row, term, n = self.found(buf, off)
        w = (1 + np.log(n)) * self.weights[term]
        norm = np.sqrt(np.bincount(row, w * w, minlength=len(off) - 1))
        return row, term, w / norm[row] if len(row) else w

    def nearest(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, n_rows: int, k: int):
        """Per row (cosine, example number) of the k nearest, best first."""
        size = len(self.highest) * self.block
        place = self.long[term]
        few, many = np.flatnonzero(place < 0), np.flatnonzero(place >= 0)
        at, n = runs(self.starts, term[few])
        near = np.bincount(np.repeat(row[few] * size, n) + self.example[at], np.repeat(weight[few], n) * self.value[at], n_rows * size).astype(float, copy=False).reshape(n_rows, size)  # of no entries: integers
        wide = np.zeros((n_rows, self.highest.shape[1]))
        wide[row[many], place[many]] = weight[many]
        bound = near.reshape(n_rows, -1, self.block).max(axis=2) + wide @ self.highest.T
        last = size - min(k, size)
        least = np.partition(near, last, axis=1)[:, last] - 1e-9
        for b, columns in enumerate(self.columns):
            read = np.flatnonzero((bound[:, b] > 0) & (bound[:, b] >= least))
            near[read, b * self.block : (b + 1) * self.block] += wide[read] @ columns.T
        least = np.partition(near, last, axis=1)[:, last] - 1e-9
        out = []
        for cosine, low in zip(near, least):
            who = np.flatnonzero((cosine >= low) & (cosine > 0))
            who = who[np.lexsort((who, -np.round(cosine[who], 12)))[:k]]
            out.append((cosine[who], who))
        return out

    def votes(self, best: np.ndarray, who: np.ndarray, prior: float) -> float:
        """Share of votes for label 1, weighted by 1 / distance, with ``prior`` votes of the base rate."""
        w = 1.0 / (0.05 + 1.0 - np.minimum(best, 1.0))
        return float((w @ self.labels[who] + prior * self.base_rate) / (w.sum() + prior))

    def calibrated(self, share: np.ndarray) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-(a * logit(share) + b)))

    def shares(self, buf: np.ndarray, off: np.ndarray, k: int, prior: float):
        """Vote shares of the rows and (cosine, example) of each row's neighbours; rows without known terms have none."""
        row, term, w = self.vectors(buf, off)
        share, found = np.full(len(off) - 1, self.base_rate), {}
        if len(self.labels) and len(row):
            some = max(1, CELLS // (len(self.highest) * self.block))
            read = np.concatenate(([0], np.cumsum(np.where(self.long[term] < 0, self.starts[term + 1] - self.starts[term], 0))))
            first = 0
            while first < len(share):
                a = np.searchsorted(row, first)
                far = np.searchsorted(read, read[a] + HITS, side="right") - 1
                whole = int(row[far]) if far < len(row) else len(share)
                to = min(first + some, max(first + 1, whole), len(share))
                z = np.searchsorted(row, to)
                for r, hits in enumerate(self.nearest(row[a:z] - first, term[a:z], w[a:z], to - first, k), first):
                    found[r], share[r] = hits, self.votes(*hits, prior)
                first = to
        return share, found


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_curve(share: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of the votes' logit (Newton steps, a weak pull towards slope 1); rising always."""
    x, w = np.column_stack([logit(share), np.ones(len(y))]), np.array([1.0, 0.0])
    if not 0 < y.sum() < len(y):
        return 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), x.T @ (y - p) - (w - [1.0, 0.0]))
        w = w + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_sample: int, max_bytes: int, id_col, text_col, label_col) -> DataFrame:
    """At most ``max_sample`` labelled texts (smallest hashes of the id), one per id: name, text, y, and whether it is an example."""
    own = labels.select(labels[id_col].alias("lid"), labels[label_col].cast("int").alias("y")).na.drop().groupBy("lid").agg(F.max("y").alias("y"))
    own = own.orderBy(F.xxhash64("lid"), "lid").limit(max_sample)
    text = docs.select(docs[id_col].alias("lid"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")).filter(F.octet_length("text") <= max_bytes)
    one = text.join(F.broadcast(own), "lid").groupBy("lid").agg(F.min("text").alias("text"), F.max("y").alias("y"))
    return one.select(F.col("lid").cast("string").alias("name"), "text", "y", (F.pmod(F.xxhash64("lid", F.lit(6)), F.lit(4)) != 0).alias("example"))


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic", max_sample=4_096, max_bytes=20_000, floor=0.02, block=32, long_lists=512, k=16, prior=1.0) -> Model:
    """The model of a bounded sample; ``k`` and ``prior`` are those that the curve is fitted for."""
    sample = stage(labelled_sample(docs, labels, max_sample, max_bytes, id_col, text_col, label_col), "op6-sample")

    def count(batches):
        for batch, buf, off in blocks(batches, "text", TEXT_BYTES):
            row, h, _ = row_terms(buf, off)
            y = np.array(batch.column("y").to_pylist())[row]
            t, at = np.unique(h, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(np.bincount(at, y == 1, len(t)).astype(np.int64)), pa.array(np.bincount(at, y != 1, len(t)).astype(np.int64))], names=["term", "pos", "neg"])

    size = sample.filter("example").agg(F.count("*").alias("n"), F.sum("y").alias("pos")).first()
    n, pos = size["n"], size["pos"] or 0
    counted = sample.filter("example").select("text", "y").mapInArrow(count, "term long, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    cells = counted.toArrow()  # the terms of a bounded sample
    terms = cells["term"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(terms)
    terms, a, b = terms[order], cells["pos"].to_numpy()[order].astype(float), cells["neg"].to_numpy()[order].astype(float)
    neg = n - pos
    away = (a + b) * (n - a - b) * float(max(pos, 1) * max(neg, 1))
    phi = np.abs(a * (neg - b) - b * (pos - a)) / np.sqrt(np.maximum(away, 1.0))
    none = np.zeros(0)
    blank = Model(terms, np.ones(len(terms)), none, none, none, none, none, none, none, [], 0.5, (1.0, 0.0), block)

    def frequencies(batches):
        df, rows = np.zeros(len(blank.terms), np.int64), 0
        for batch, buf, off in blocks(batches, "text", TEXT_BYTES):
            rows += batch.num_rows
            df += np.bincount(blank.found(buf, off)[1], minlength=len(df))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], rows))], names=["term", "df"])

    seen = keyed(docs, id_col, text_col).select("text").mapInArrow(frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(len(terms) + 1)
    df[seen["term"].to_numpy()] = seen["df"].to_numpy()  # the last cell counts documents
    blank.weights = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1) * (floor + phi)

    def vectorise(batches):
        for batch, buf, off in blocks(batches, "text", TEXT_BYTES):
            row, term, w = blank.vectors(buf, off)
            at = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("name"), batch.column("y"), pa.ListArray.from_arrays(pa.array(at), pa.array(term.astype(np.int32))), pa.ListArray.from_arrays(pa.array(at), pa.array(w))], names=["name", "y", "terms", "weights"])

    vectors = sample.filter("example").mapInArrow(vectorise, "name string, y int, terms array<int>, weights array<double>").filter(F.size("terms") > 0).toArrow()
    found = [(t.values.to_numpy(), w.values.to_numpy(), y, name) for t, w, y, name in zip(vectors["terms"], vectors["weights"], vectors["y"].to_pylist(), vectors["name"].to_pylist())]
    # Similar examples side by side make tight blocks.
    found.sort(key=lambda r: (r[0][int(np.argmax(r[1]))], r[2], r[3]))
    t, w, e = (np.concatenate(x) if found else none.astype(np.int64) for x in ([r[0] for r in found], [r[1] for r in found], [np.full(len(r[0]), i) for i, r in enumerate(found)]))
    held = np.bincount(t, minlength=len(terms))
    frequent = np.sort(np.lexsort((np.arange(len(held)), -held))[:long_lists])
    long = np.full(len(terms), -1)
    long[frequent] = np.arange(len(frequent))
    n_blocks = -(-len(found) // block)
    columns = np.zeros((n_blocks * block, len(frequent)))
    own = long[t] >= 0
    columns[e[own], long[t[own]]] = w[own]
    columns = columns.reshape(n_blocks, block, len(frequent))
    t, w, e = t[~own], w[~own], e[~own]
    by = np.argsort(t, kind="stable")
    model = Model(terms, blank.weights, long, np.searchsorted(t[by], np.arange(len(terms) + 1)), e[by].astype(np.int32), w[by], columns, columns.max(axis=1, initial=0.0), np.array([r[2] for r in found], float), [r[3] for r in found], pos / n if n else 0.5, (1.0, 0.0), block)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches):
        for batch, buf, off in blocks(batches, "text", TEXT_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array(shared.value.shares(buf, off, k, prior)[0]), batch.column("y")], names=["share", "y"])

    held = sample.filter("NOT example").select("text", "y").mapInArrow(judge, "share double, y int").toArrow()
    model.curve = fit_curve(held["share"].to_numpy(), held["y"].to_numpy().astype(float))
    shared.destroy()
    return model


def score(docs: DataFrame, model: Model, id_col="doc_id", text_col="text", k=16, prior=1.0, extra: tuple[str, ...] = ()) -> DataFrame:
    """id, ``th`` (text hash), score, and evidence: ids of the nearest examples with cosine and label."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = keyed(docs, id_col, text_col, extra)
    kinds = {"kid": "bigint", "th": "bigint", "score": "double", "evidence": "array<struct<example:string,cosine:double,label:int>>"} | {c: rows.schema[c].dataType.simpleString() for c in extra}
    evidence_type = pa.list_(pa.struct([("example", pa.string()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def run(batches):
        m = shared.value
        for batch, buf, off in blocks(batches, "text", TEXT_BYTES):
            share, found = m.shares(buf, off, k, prior)
            evidence = [[{"example": m.names[x], "cosine": c, "label": int(m.labels[x])} for c, x in zip(*(v.tolist() for v in found.get(r, ((np.zeros(0),) * 2))))] for r in range(batch.num_rows)]
            cells = {"score": pa.array(m.calibrated(share)), "evidence": pa.array(evidence, evidence_type)}
            yield pa.RecordBatch.from_arrays([cells[c] if c in cells else batch.column(c) for c in kinds], names=list(kinds))

    return rows.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in kinds.items())).select(id_back().alias(id_col), "th", "score", "evidence", *extra)


def held_out(column: str = "doc_id"):
    """Rows that no model may learn from: crc32 of the id as text divisible by 5."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(False))
