"""The Jaccard join and the suffix-array dedup against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recsignals.llm import op09_jaccard_join

SF = "/root/testdata/sf0.01"


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            where[g].append(i)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for j in where[g]:
                if j < i:
                    shared[j] += 1
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)), key=repr)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    base = [word() for _ in range(60)]
    passage = [word() for _ in range(40)]
    made = [(10**6 + i, None) for i in range(3)] + [(10**6 + 10, ""), (10**6 + 11, "one two"), (10**6 + 12, "One  TWO"), (10**6 + 13, "one two three"), (None, "one two"), (None, " ".join(word() for _ in range(30)))]
    for i in range(150):  # a family of near copies, many borderline, and exact copies
        w = list(base)
        for _ in range(i % 5):
            w[rng.randrange(len(w))] = word()
        made.append((2 * 10**6 + i, " ".join(w + [word() for _ in range(i % 9)])))
    for i in range(150):  # a passage in otherwise different texts of many sizes
        made.append((3 * 10**6 + i, " ".join([word() for _ in range(i % 50)] + passage + [word() for _ in range(i % 7)])))
    made += [(7, made[20][1]), (7, made[20][1])]
    extra = spark.createDataFrame(made, "doc_id long, text string")
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(extra).withColumn("node", F.lit("clash")).withColumn("n", F.lit(1)).repartition(4)


@pytest.mark.parametrize("tile_rows", [20_000, 7])
def test_components(corpus, monkeypatch, tile_rows):
    monkeypatch.setattr(op09_jaccard_join, "TILE_ROWS", tile_rows)
    monkeypatch.setattr(op09_jaccard_join, "PIVOT_ROWS", 10 if tile_rows == 7 else 2000)
    members, links = op09_jaccard_join.join(corpus)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in op09_jaccard_join.summary(members).collect()), key=repr)
    assert got == brute_components([(r.doc_id, r.text) for r in corpus.collect()])


def test_empty_join(corpus):
    members, links = op09_jaccard_join.join(corpus.limit(0))
    assert op09_jaccard_join.summary(members).count() == 0 and links.count() == 0


def brute_repeats(rows, span):
    where = defaultdict(int)
    raw = [(t or "").encode() for _, t in rows]
    for b in raw:
        for i in range(len(b) - span + 1):
            where[b[i : i + span]] += 1
    out = []
    for (d, _), b in zip(rows, raw):
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if where[b[i : i + span]] > 1:
                gone[i : i + span] = b"\1" * span
        runs = [[m.start(), m.end()] for m in re.finditer(b"\1+", bytes(gone))]
        out.append((d, bytes(x for x, g in zip(b, gone) if not g), len(b), runs))
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_repeats(spark, monkeypatch, small):
    from recsignals.llm import op04_suffix_dedup as op

    if small:  # every path: hot buckets, many blocks, joins by shuffle
        for name, value in (("HOT_CONTEXTS", 3), ("BLOCK_TEXT", 4000), ("BUCKET_ANCHORS", 500), ("BUCKET_CONTEXTS", 10_000), ("BROADCAST_BYTES", 0)):
            monkeypatch.setattr(op, name, value)
    rng = random.Random(3)
    junk = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    common, other = junk(330), junk(230)
    rows = [(i, junk(rng.randrange(400)) + common[rng.randrange(60) : 330 - rng.randrange(60)] + junk(rng.randrange(300)) + (other if i % 3 else other[:185])) for i in range(60)]
    rows += [(100, "ab" * 700), (101, "x" * 900), (102, "x" * 199), (103, None), (104, ""), (None, common), (105, common + common), (106, rows[5][1]), (106, rows[5][1]), (107, junk(60_000)), (108, other[:199])]
    rows += [(200 + r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, runs string, start int").repartition(5)
    got = sorted(((r.doc_id, bytes(r.kept), r.n_bytes, [list(x) for x in r.runs]) for r in op.dedup(docs).collect()), key=repr)
    assert got == brute_repeats(rows, 200)
    assert op.dedup(docs.limit(0)).count() == 0


def test_entries_are_packed_narrow():
    """Sizes and places below 65,536 take two bytes each, bitmaps at most two bits per shingle; larger ones are read as well."""
    import numpy as np

    for kind in (np.uint16, np.int32):
        x = np.array([3, 65_535, 7], kind)
        assert op09_jaccard_join.numbers(x.tobytes(), 3).tolist() == x.tolist()
    for n in (1, 64, 100, 1000):
        x = np.sort(np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64))
        assert len(op09_jaccard_join.bitmap(x)) <= max(8, n // 4)


def test_small_tables_take_few_tasks(spark, monkeypatch):
    """However many shuffle partitions a session has, components of few edges are found and stored in few tasks."""
    from recsignals.llm import graph

    parts, stage = [], graph.stage
    monkeypatch.setattr(graph, "stage", lambda df, name: parts.append(df.rdd.getNumPartitions()) or stage(df, name))
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 20)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        edges = spark.createDataFrame([(i, i + 1) for i in range(8)] + [(i, 100) for i in range(101, 130)] + [(200, 201), (201, 200), (300, 300)], "a long, b long")
        for limit in (graph.BROADCAST_BYTES, 0):  # also by shuffles
            monkeypatch.setattr(graph, "BROADCAST_BYTES", limit)
            got = dict(map(tuple, graph.components(edges).collect()))
            assert got == {i: 0 for i in range(9)} | {i: 100 for i in range(100, 130)} | {200: 200, 201: 200}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert len(parts) > 3 and max(parts) <= 12


def test_anchors_are_held_in_bounded_runs(spark, monkeypatch):
    from recsignals.llm import op04_suffix_dedup as op
    from recsignals.llm.common import keyed

    monkeypatch.setattr(op, "TASK_ANCHORS", 2_000)
    monkeypatch.setattr(op, "_SCAN_BYTES", 20_000)
    rng = random.Random(9)
    docs = spark.createDataFrame([(i, "".join(rng.choices("abcdefgh ", k=10_000))) for i in range(60)], "doc_id long, text string").coalesce(1)
    rows = op._anchor_rows(keyed(docs, "doc_id", "text"), 200, 96, 1).filter("bucket is not null").collect()
    assert len(rows) > 2 and max(len(r.p_h) // 8 for r in rows) < 3_000


def test_anchors_meet_in_bounded_parts(monkeypatch):
    from recsignals.llm import op04_suffix_dedup as op

    class Packed:  # hands over the function that works on a bucket
        def groupBy(self, _):
            return self

        def applyInArrow(self, run, _):
            return run

    rng = np.random.default_rng(3)
    n = 4_000
    cols = {"h": rng.integers(0, 900, n), "c": rng.integers(0, 3, n), "kid": np.arange(n), "th": np.arange(n) * 7, "start": rng.integers(0, 999, n), "size": rng.integers(1, 99, n), "ahead": rng.integers(0, 99, n), "done": rng.integers(0, 2, n)}
    got = {f"p_{k}": [cols[k][a : a + 1_000].astype(t).tobytes() for a in range(0, n, 1_000)] for k, t in op._ARRAYS.items()}
    bucket = pa.table({k: pa.array(v, pa.binary()) for k, v in got.items()})
    seen = []
    sort = np.lexsort
    monkeypatch.setattr(op.np, "lexsort", lambda keys: seen.append(len(keys[0])) or sort(keys))
    rows = {}
    for limit in (n, 400):
        monkeypatch.setattr(op, "MEET_ANCHORS", limit)
        seen.clear()
        rows[limit] = sorted(map(repr, op._meet(Packed(), 200)(bucket).drop_columns(["kid", "th", "start", "end", "ahead"]).to_pylist()))
    assert len(seen) == 10 and max(seen) < 600 and sum(seen) == n
    assert rows[n] == rows[400] and len(rows[n]) > 2_000


def test_removal_and_decoding_share_a_worker(spark):
    import corpus_pipeline

    same = "äöü€" * 60
    docs = spark.createDataFrame([(1, "x" + same, 5, "a"), (2, "yé" + same, 6, "b"), (3, None, None, "c")], "doc_id long, text string, n_chars int, other string")
    out = corpus_pipeline.suffix_dedup(spark, docs, "")
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(map(tuple, out.collect())) == [(1, "x", 1, "a"), (2, "yé", 2, "b"), (3, "", 0, "c")]
