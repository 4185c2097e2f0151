"""Vector codes against plain Python integers."""

import hashlib
import math

import numpy as np
import pytest

from recsignals.llm import op11_vector_codes as op


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    seeds = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for _, v, _ in seeds] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min((dist(x, c), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = [near(cut(v, p), books[p])[1] for _, v, _ in kept]
            for e in range(len(books[p])):
                mine = [cut(v, p) for (_, v, _), o in zip(kept, own) if o == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    h = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out = []
    for i, v, label in kept:
        best = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label))
    total = {}
    for _, _, err, label in out:
        total[label] = total.get(label, 0) + err
    return [(i, c, err, total[label], h) for i, c, err, label in out]


def run(spark, rows):
    docs = spark.createDataFrame([(i, v, label, 1, 2, "x") for i, v, label in rows], "vec_id long, embedding array<float>, label int, row int, part int, v string").repartition(3)
    return [tuple(r) for r in op.codes(docs).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()]


def key(r):
    return tuple((x is None, x) for x in r)


def check(spark, rows):
    rows = [(i, v and [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert sorted(run(spark, rows), key=key) == sorted(brute(rows), key=key)


def test_rounds_ties_repeats_and_nulls(spark):
    r = np.random.default_rng(5)
    rows = [(i, r.normal(0, 0.2, 24).tolist(), i % 3 or None) for i in range(700)]
    rows += [(1000 + i, rows[7][1], 1) for i in range(600)]  # one vector that many rows share
    rows += [(7, rows[9][1], 2), (7, rows[7][1], 0), (None, rows[3][1], 0), (2000, None, 1), (2001, [None] + [0.5] * 23, 1), (2002, [float("nan")] * 24, 1), (2003, [float("-inf")] * 24, 1), (2004, [], 1)]
    rows += [(3000 + i, [round(x * 4) / 4 for x in r.normal(0, 0.5, 24)], 5) for i in range(300)]  # ties
    check(spark, rows)


def test_large_components(spark):
    r = np.random.default_rng(6)
    check(spark, [(i, (r.normal(0, 1, 8) * 10.0 ** int(r.integers(0, 5))).tolist(), 0) for i in range(60)])


def test_few_rows(spark):
    check(spark, [(i, [float(i + j) for j in range(8)], None) for i in range(5)])
    rows = run(spark, [(i, [1e30 * (-1) ** i] * 16, 1) for i in range(20)])
    assert len(rows) == 20
    assert len(run(spark, [(1, [1.0] * 8, 0), (2, [1.0] * 8, 0), (3, [1.0] * 16, 0), (4, [1.0] * 7, 0)])) == 2


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(1, None, 1), (2, [1.0] * 7, 1)]) == []


def test_shortlist_decides_like_all_entries():
    r = np.random.default_rng(7)
    for size in (5, 50):
        x = np.sort(r.integers(-20, 20, (size, 3)), axis=0)
        book = r.integers(-20, 20, (16, 3))
        d = ((x[:, None] - book[None]) ** 2).sum(2)
        entry, least = op.nearest(x.min(0), x.max(0), lambda: x, book, True)
        assert (entry == d.argmin(1)).all() and (least == d.min(1)).all()
    point = np.zeros((4, 3), np.int64)
    assert op.nearest(point[0], point[0], None, np.array([[5, 5, 5], [1, 0, 0]]), False) == (1, None)


def test_hilbert_curve_steps_to_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    coarse = op.hilbert_keys(grid, 0, 8)
    assert len(np.unique(coarse)) == len(grid)
    walk = grid[np.argsort(coarse)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("d", [1, 2, 8, 100])
def test_hilbert_any_width(d):
    x = np.random.default_rng(1).integers(-100, 100, (50, d))
    assert op.hilbert_keys(x, -100, 100).shape == (50,)
