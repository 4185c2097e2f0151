"""URL rules, decontamination, quality rules and licence digests against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from recsignals.llm import op02_url_filter, op05_decontaminate, op07_quality, op08_licences
from recsignals.llm.licence_texts import full_texts
from recsignals.llm.queries import URL_RULES

SF = "/root/testdata/sf0.001"
EDGE = [(900001, None), (900002, ""), (900003, "  \n\t "), (900004, "a b c d e a b c d e f"), (900004, "a b c d e a b c d e f"), (None, "Null id text, with the words of and to."), (900005, "x" * 200000), (900006, "tic " * 3000)]


@pytest.fixture(scope="module")
def docs(spark):
    extra = spark.createDataFrame([(a, b) for a, b in EDGE], "doc_id long, text string")
    from pyspark.sql import functions as F

    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(extra).withColumn("lines", F.lit("clash")).withColumn("kid", F.lit("clash")).withColumn("words", F.lit(1))


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


URLS = [None, "", "no scheme", "http://", "http://A.Example.NET/en/x?y#z", "https://example.net/fr/", "http://net", "http://net/", "http://xnet/", "http://a.org/fr/1", "http://a.org/de/", "ftp://u@x.example.com/de/1://net/", "http://example.com/dex", "x://a.net?://b.org/fr/", "http://ü.net/ü", "http://.net/", "http://a..org/fr/"]


def test_urls(spark):
    def plain(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fit = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fit)[1:] if fit else (None, "allow")))

    urls = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS + URLS[:2])], "page_id long, url string, host string").drop("host")
    given = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    both = urls.unionByName(given)
    want = sorted(((r.page_id, *plain(r.url)) for r in both.collect()), key=repr)
    assert rows(op02_url_filter.apply_rules(both, URL_RULES), "page_id", "host", "path", "rule", "verdict") == want
    listed = spark.createDataFrame(URL_RULES + [(f"h{i}.com", "/", "block") for i in range(500)], "host string, path string, verdict string")
    assert rows(op02_url_filter.apply_rules(both, listed, block_bytes=4000), "page_id", "host", "path", "rule", "verdict") == want
    assert op02_url_filter.apply_rules(both.limit(0), URL_RULES).count() == 0


def test_decontaminate(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(5000, "a b c"), (5001, "tic tic"), (5002, None), (5003, ""), (5004, "A b, C d e a b c d e f"), (5004, "A b, C d e a b c d e f"), (None, "Null id text")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for i, t in items:
        w = words(t)
        for a in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[a : a + 10]), set()).add("" if i is None else str(i))
    want = []
    for r in docs.collect():
        w, hit, got = words(r.text), set(), set()
        for m in {len(k) for k in windows}:
            for a in range(len(w) - m + 1):
                if tuple(w[a : a + m]) in windows:
                    hit.update(range(a, a + m))
                    got |= windows[tuple(w[a : a + m])]
        want.append((r.doc_id, len(w), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest(), bool(hit)))
    want.sort(key=repr)
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    for block in (8 << 20, 3000):
        assert rows(op05_decontaminate.summary(op05_decontaminate.decontaminate(docs, bench, block_bytes=block)), *cols) == want
    assert op05_decontaminate.decontaminate(docs.limit(0), bench).count() == 0
    assert not any(r.contaminated for r in op05_decontaminate.summary(op05_decontaminate.decontaminate(docs, bench.limit(0))).collect())


def test_quality(docs):
    def js(p, q):
        f = lambda a, b: a * math.log2(a / b) if a else 0
        return sum((f(a, (a + b) / 2) + f(b, (a + b) / 2)) / 2 for a, b in zip(p, q))

    want = []
    for r in docs.collect():
        t = r.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        n = len(w)
        chars, sym = sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t))
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        win = Counter(tuple(w[i : i + 5]) for i in range(n - 4))
        rep = len({i + j for i in range(n - 4) if win[tuple(w[i : i + 5])] > 1 for j in range(5)})
        base = n < 10 or 100 * rep > 20 * n
        odd = False
        if n:
            up, marks = (len(re.findall(x, t)) for x in ("[A-Z]", r"[!-/:-@\[-`{-~]"))
            c = [chars - up - marks, up, len(t) - chars, marks - sym, sym]
            by = []
            low = Counter(x.lower() for x in w)
            for words in op07_quality.COMMON_WORDS.values():
                k = [low[x] for x in words]
                by.append(js([x / n for x in [*k, n - sum(k)]], [*op07_quality.RANK_SHARES, 1 - sum(op07_quality.RANK_SHARES)]))
            odd = n >= 10 and js([x / len(t) for x in c], op07_quality.CHAR_CLASSES) > 0.025 + 0.3 / n or n >= 60 and min(by) > op07_quality.NO_COMMON_WORD * (0.5 + 25 / n)
        want.append((r.doc_id, n, chars, sym, len(lines) - len(set(lines)), rep, base, not base and not odd))
    got = rows(op07_quality.judge(op07_quality.measures(docs)), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert got == sorted(want, key=repr)


def test_licences(spark):
    mit = dict(reversed(op08_licences.LICENCES))["ISC"]
    texts = [
        (1, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ,")),
        (2, "some prose\nReleased under the MIT Licence\n© me\nLicensed under CC BY-NC 4.0."),
        (3, None), (4, ""), (5, "prose that says released under the MIT License in a sentence"), (5, "prose that says released under the MIT License in a sentence"), (6, "***"), (None, "Released under the MIT License."),
    ]
    df = spark.createDataFrame([(a, b, "x", "y") for a, b in texts], "doc_id long, text string, digest string, licence string")
    got = {r.doc_id: (r.licence, r.notices, r.digest is None) for r in op08_licences.scan(df).collect()}
    assert got == {1: ("ISC", [], False), 2: (None, ["CC-BY-NC-4.0", "MIT"], False), 3: (None, [], True), 4: (None, [], True), 5: (None, [], False), 6: (None, [], True), None: ("MIT", ["MIT"], False)}
    assert op08_licences.scan(df).count() == len(texts) and op08_licences.scan(df.limit(0)).count() == 0


def test_quality_labels(spark):
    """Clean labelled texts stay, junk goes."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = op07_quality.judge(op07_quality.measures(spark.read.parquet(f"{sf}/documents.parquet"))).join(labels, "doc_id").toPandas()
    good = got[(got["quality"] == 1) & ~got["base_failed"]]
    assert good["kept"].mean() > 0.995 and got[got["quality"] == 0]["kept"].mean() < 0.05


def test_quality_common_words(spark):
    """Texts without common words fail by the words alone; clean labelled texts are far from the limit."""
    draw = random.Random(7)
    salad = lambda n: ["".join(draw.choices("bcfgjkmpvwxz", k=1) + draw.choices("abefghiklmnoprstuvz", k=draw.randint(3, 6))) for _ in range(n)]
    line = lambda w: ". ".join(" ".join([w[a].capitalize(), *w[a + 1 : a + 12]]) for a in range(0, len(w), 12)) + "."
    prose = lambda n, own: [own[0] if i % 18 == 0 else own[1] if i % 35 == 1 else own[i // 11 % 8] if i % 11 == 5 else w for i, w in enumerate(salad(n))]
    texts = [(n, line(salad(n))) for n in (40, 60, 90, 200, 1000)]
    texts += [(10_000 * (1 + k) + n, line(prose(n, own))) for k, own in enumerate(op07_quality.COMMON_WORDS.values()) for n in (60, 200, 1000)]
    got = {r.doc_id: r for r in op07_quality.judge(op07_quality.measures(spark.createDataFrame(texts, "doc_id long, text string"))).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {i for i, r in got.items() if r.kept} == {40} | {i for i, _ in texts if i > 10_000}
    assert all(abs(got[n].word_divergence - op07_quality.NO_COMMON_WORD) < 1e-12 for n in (60, 90, 200, 1000))
    sf = "/root/testdata/sf0.01"
    good = op07_quality.measures(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1"), "doc_id").filter("n_words >= 60").toPandas()
    assert len(good) > 100 and (good["word_divergence"] < 0.9 * op07_quality.NO_COMMON_WORD * (0.5 + 25 / good["n_words"])).all()


def test_full_licences(spark):
    """Whole texts of the usual licences are known by their digest, as they are passed on; changed ones are not."""
    full = full_texts()
    assert {n for n, _ in full} >= {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0"}
    unwrapped = lambda t: "\n".join(x if re.match(r"\s*copyright \(c\)", x, re.I) else " ".join(x.split()) for x in re.sub(r"(?mi)^(?!\s*copyright \(c\))(.*\S)[ \t]*\n(?=[ \t]*\S)", r"\1 ", t).split("\n"))
    ways = [lambda t: t, lambda t: "Copyright 2020 Someone\n\n" + t.upper(), unwrapped, lambda t: t.replace("https://", "http://"), lambda t: re.split("(?<=END OF TERMS AND CONDITIONS)", t)[0]]
    texts = [(100 * i + k, way(t), n) for i, (n, t) in enumerate(full) for k, way in enumerate(ways)]
    texts += [(100 * i + 99, t + "\nBut not on Sundays.", None) for i, (_, t) in enumerate(full)]
    got = {r.doc_id: r.licence for r in op08_licences.scan(spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")).collect()}
    assert got == {i: n for i, _, n in texts}
