"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import pytest

from recsignals.llm import op12_phrases as op

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            own = f.setdefault(lang, Counter())
            for k in range(1, 6):
                own.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        cand = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for q, a in cand.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    inside[q[i : i + m]] = max(inside[q[i : i + m]], a)
        scored = []
        for p, a in cand.items():
            if p in inside and 100 * inside[p] >= 100 * a:
                continue
            score, k = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def made(seed, docs):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["Été", "the", "THE", "x\x1cy", " ", "q "]
    rows = []
    for i in range(docs):
        text = "".join(r.choice(words) + r.choice([" ", " ", "  ", "\t", " ", ". ", "\n", "\r\n", "!"]) for _ in range(r.randint(0, 60)))
        rows.append((r.choice(["en", "en", "de", None, "und"]), text + r.choice(["", " alpha beta gamma delta epsilon zeta", " New York city"])))
    return rows + [("en", None), ("en", ""), (None, " \t\n"), ("fr", "only once here"), ("en", "the end " * 3000), *[("de", "same text here again")] * 40]


@pytest.mark.parametrize("least,top,shards", [(3, 2000, 3), (12, 7, 2), (30, 2000, 4), (2, 50, 1)])
def test_against_counting(spark, monkeypatch, least, top, shards):
    monkeypatch.setattr(op, "SLOT_BITS", (6, 8) if shards == 4 else (16, 25))  # crowded slots change cost only
    monkeypatch.setattr(op, "COUNTER_BITS", (8, 9) if least > 10 else (16, 27))
    monkeypatch.setattr(op, "BLOCK_BYTES", 3000)
    rows = made(least, 200)
    docs = spark.createDataFrame([(a, b, "x", 5, 0) for a, b in rows], "lang string, text string, phrase string, k int, shard int").repartition(5)
    got = op.collocations(docs, least=least, top=top, shards=shards)
    assert sorted(map(tuple, got.collect())) == brute(rows, least, top)


def test_counts_hold_every_level(spark):
    rows = [("en", "a b c d e f " * 10)] * 3
    got = {(r.phrase, r.n) for r in op.phrase_counts(spark.createDataFrame(rows, "lang string, text string"), least=27).collect()}
    assert ("a b c d e", 30) in got and ("f a b c d", 27) in got and ("", 180) in got and ("a", 30) in got


def test_empty(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert op.collocations(none).count() == 0
    assert op.collocations(spark.createDataFrame([("en", None), (None, "one two")], "lang string, text string")).count() == 0


def test_longer_phrases_are_counted_only_if_they_may_reach_the_threshold(spark, monkeypatch):
    counted, scan = Counter(), op.scan

    def watched(*args):
        out = scan(*args)
        counted.update(r.phrase for r in out.collect() if r.k >= 3)
        return out

    monkeypatch.setattr(op, "scan", watched)
    rows = [("en", "a b. b c. c d. " * 30 + "a b c d. a b c. " + "p q r s t. " * 20)] * 2
    got = {r.phrase: r.n for r in op.phrase_counts(spark.createDataFrame(rows, "lang string, text string"), least=30).collect()}
    assert got["a b"] == 64 and got["b c"] == 64 and got["p q r s t"] == 40
    assert set(counted) == {"p q r", "q r s", "r s t", "p q r s", "q r s t", "p q r s t"}


def test_a_task_sends_each_phrase_once(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_BYTES", 100)
    sent, scan = [], op.scan

    def watched(*args):
        out = scan(*args)
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()  # rows as the tasks made them
        sent.append(Counter((r.lang, r.phrase) for r in out.collect()))
        return out

    monkeypatch.setattr(op, "scan", watched)
    docs = spark.createDataFrame([("en", "a b c d"), ("de", "a b")] * 200, "lang string, text string").coalesce(1)
    got = {(r.lang, r.phrase): r.n for r in op.phrase_counts(docs, least=100).collect()}
    assert got["en", "a b c d"] == 200 and got["de", "a b"] == 200 and got["de", ""] == 400
    assert sum(map(len, sent)) > 20 and max(max(x.values()) for x in sent if x) == 1


def test_counters_travel_small():
    import numpy as np

    steps = np.diff(np.flatnonzero(np.random.default_rng(1).random(1 << 16) < 0.02), prepend=0).astype(np.int32)
    assert len(op.zipped(steps)) < 2 * len(steps) and (op.unzipped(op.zipped(steps), len(steps), np.int32) == steps).all()
