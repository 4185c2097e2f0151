"""Toxicity against exhaustive nearest neighbours, extraction on written pages, and the pipeline's stages."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recsignals.llm import op03_html, op06_toxicity
from recsignals.llm.queries import QUERIES
from recsignals.llm.textbuf import text_view

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return op06_toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet").filter(~op06_toxicity.held_out()), block=8, long_lists=64)


def test_nearest_are_exact(spark, model):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(300).collect()]
    row, term, w = model.vectors(*text_view(pa.array(texts)))
    dense = np.zeros((len(model.labels), len(model.terms)))
    dense[model.example, np.repeat(np.arange(len(model.terms)), np.diff(model.starts))] = model.value
    frequent = np.flatnonzero(model.long >= 0)
    dense[:, frequent] = model.columns.reshape(-1, len(frequent))[: len(dense)]
    assert len(frequent) == 64 and len(model.terms) > 50_000
    assert np.allclose((dense**2).sum(axis=1), 1)
    seen = 0
    found = model.nearest(row, term, w, len(texts), 16)
    for r in range(len(texts)):
        own = row == r
        cosine = dense[:, term[own]] @ w[own]
        order = np.lexsort((np.arange(len(cosine)), -np.round(cosine, 12)))[:16]
        order = order[cosine[order] > 0]
        best, who = found[r]
        assert who.tolist() == order.tolist() and np.allclose(best, cosine[order])
        seen += 1
    assert seen > 290


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op6_toxicity"](spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert (got["predicted"] == got["toxic"]).mean() > 0.96 and got["score"].between(0, 1).all()
    rank = got["score"].rank()
    pos = (got["toxic"] == 1).sum()
    assert (rank[got["toxic"] == 1].sum() - pos * (pos + 1) / 2) / pos / (len(got) - pos) > 0.98
    # Calibration: in each band of scores the share of toxic rows is near the mean score.
    for low, high in ((0, 0.1), (0.1, 0.5), (0.5, 0.9), (0.9, 1.01)):
        band = got[(got["score"] >= low) & (got["score"] < high)]
        if len(band):
            p = band["score"].mean()
            assert abs(band["toxic"].mean() - p) <= 0.05 + 3 * (max(p * (1 - p), 0.01) / len(band)) ** 0.5


def test_toxicity_edges(spark, model):
    rows = [(1, None), (1, None), (2, ""), (None, "idiot " * 50), (4, "x" * 100_000)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, score string, label int")
    got = op06_toxicity.score(docs, model).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (1, 2)} == {float(model.calibrated(np.array([model.base_rate]))[0])}
    none = op06_toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in op06_toxicity.score(docs, none).collect()} == {0.5}
    assert op06_toxicity.score(docs.limit(0), model).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav><div class="cookie-notice">We use cookies.</div>
%s<aside>Side</aside><div id="comments"><article><p>A reader says something long enough to be dense text, really quite long.</p></article></div>
<form><label>Name</label></form><script>var t="</p>";</script><footer>&copy; x</footer></body></html>"""
BODY = "<h1>Head &amp; line</h1><p>First   para&shy;graph\nwith <b>bold</b> text that is long enough to count as dense.<p>Short.<div class='ad'>Buy</div><ul><li>one</li><li>two &lt;three&gt;</ul><p>Last &#8212; one, once more of a fair length for a line."
WANT = "Head & line\nFirst para\xadgraph with bold text that is long enough to count as dense.\nShort.\none\ntwo <three>\nLast — one, once more of a fair length for a line."


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", "<div class='post'>%s</div>", "<div class='ad'>open<article>%s</article>"])
def test_pages(wrap):
    assert op03_html.main_text(PAGE % (wrap % BODY)) == WANT


LONG = "<p>" + "A paragraph of main text that goes on for quite a while, with several clauses. " * 5 + "</p>"
LINKS = "<ul>" + "".join(f"<li><a href='/{i}'>Other story {i}</a></li>" for i in range(12)) + "</ul>"


@pytest.mark.parametrize(
    "page, want",
    [
        ("<main><h1>Head</h1><p>Short lead.</p><article>@@@@</article><p>End.</p></main>", ["Head", "Short lead.", "@", "@", "@", "@", "End."]),
        ("<article><h2>One</h2>@@@@</article><article><h2>Two</h2><p>Brief.</p></article><article><h2>Three</h2>@@@</article>", ["One", "@", "@", "@", "@", "Two", "Brief.", "Three", "@", "@", "@"]),
        ("<article><h2>One</h2>@@@@<p>Brief.</p>#</article>", ["One", "@", "@", "@", "@", "Brief."]),
        ("<article><h2>One</h2>@@@@</article><article><h3><a href='/x'>A linked headline</a></h3><p>Snip.</p></article>" + "<article><h3><a href='/y'>Another headline</a></h3><p>Snip.</p></article>" * 3, ["One", "@", "@", "@", "@"]),
        ("<article><p>Only.</p></article>", ["Only."]),
        ("<article>#</article>", [f"Other story {i}" for i in range(12)]),
    ],
)
def test_marked_parts(page, want):
    """The ratios choose among marked parts, single ones too; short text beside dense text stays."""
    text = " ".join(LONG[3:-4].split())
    assert op03_html.main_text(PAGE % page.replace("@", LONG).replace("#", LINKS)).split("\n") == [text if x == "@" else x for x in want]


def test_tags_of_skipped_blocks():
    parser = op03_html.Lines()
    parser.feed(PAGE % "<article><p>First.</p><nav><ul><li>x</ul></nav><p>Second.</p></article>")
    assert [x[:2] for x in parser.lines] == [("First.", 3), ("Second.", 2)]


def test_extraction(spark):
    def plain(html):
        a = html[html.index("<article>") + 9 : html.index("</article>")]
        import html as h

        parts = [" ".join(h.unescape(re.sub("<[^>]+>", "", p)).split()) for p in re.split(r"</?(?:p|h1|br)\s*>", a)]
        return "\n".join(p for p in parts if p)

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op3_html_extraction"](spark, SF).collect()}
    assert got == {r.page_id: (plain(r.html), len(plain(r.html))) for r in pages.collect()}
    odd = spark.createDataFrame([(1, None, None), (1, None, None), (2, "u", ""), (3, "u", "<p"), (4, "u", "no tags at all"), (5, "u", "<article></article>"), (None, "u", "<article><p>x" + "<b>" * 3000)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert sorted(((r.page_id, r.text) for r in op03_html.extract(odd).collect()), key=repr) == sorted([(1, ""), (1, ""), (2, ""), (3, "<p"), (4, "no tags at all"), (5, ""), (None, "x")], key=repr)
    assert op03_html.extract(odd.limit(0)).count() == 0


def test_pipeline_stages(spark):
    from tests.llm.test_pairs import brute_components, brute_repeats

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = docs.filter("doc_id < 20").withColumn("doc_id", F.col("doc_id") + 5000)  # exact copies with other ids
    odd = spark.createDataFrame([(None, None, "en", "s", None), (9000, "", None, None, 0), (9001, None, None, None, None)], docs.schema)
    docs = docs.unionByName(extra).unionByName(docs.filter("doc_id < 5")).unionByName(odd)
    columns, bench = docs.columns, [r.text for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").lower())
    windows = {tuple(w[i : i + 10]) for w in map(words, bench) for i in range(len(w) - 9)}
    plain = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    for name, step in corpus_pipeline.STAGES[:4]:
        before, out = plain(docs), step(spark, docs, "/root/testdata/sf0.001").cache()
        after = plain(out)
        assert out.columns == columns and out.dtypes == docs.dtypes
        if name == "toxicity":
            assert set(after) <= set(before) and len(after) > 0.8 * len(before)
        elif name == "jaccard_join":
            want = sorted({(i, t) for i, t in before if i is not None and (not words(t) or (i, i) in {(d, c) for d, _, c in brute_components(before)})} | {(None, None)}, key=repr)
            assert sorted(after, key=repr) == want
        elif name == "suffix_dedup":
            assert sorted(after, key=repr) == sorted(((d, kept.decode("utf-8", "ignore")) for d, kept, _, _ in brute_repeats(before, 200)), key=repr)
            assert all(r.n_chars == len(r.text) for r in out.collect())
        else:
            assert sorted(after, key=repr) == sorted((x for x in before if not any(tuple(words(x[1])[i : i + 10]) in windows for i in range(len(words(x[1])) - 9))), key=repr)
        docs = out
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF).toPandas()
    assert set(packed["doc_id"].dropna()) == {i for i, _ in plain(docs) if i is not None} and (packed.groupby("sequence_id")["length"].sum() <= 2048).all()


def test_short_lists_are_read_in_bounded_runs(spark, model, monkeypatch):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()] + ["", "zzzzqqq"]
    buf, off = text_view(pa.array(texts))
    want, near = model.shares(buf, off, 16, 1.0)
    sizes, runs = [], op06_toxicity.runs
    monkeypatch.setattr(op06_toxicity, "runs", lambda starts, at: (sizes.append((starts[at + 1] - starts[at]).sum()), runs(starts, at))[1])
    monkeypatch.setattr(op06_toxicity, "HITS", 1)
    model.shares(buf, off, 16, 1.0)
    most = max(sizes)  # of one text
    sizes.clear()
    monkeypatch.setattr(op06_toxicity, "HITS", 2 * int(most))
    share, found = model.shares(buf, off, 16, 1.0)
    assert max(sizes) <= 2 * most < sum(sizes) and np.allclose(share, want)
    assert all(found[r][1].tolist() == near[r][1].tolist() for r in near)
