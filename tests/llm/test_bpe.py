"""BPE codec against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from recsignals.llm import op13_bpe as op
from recsignals.llm.lexicon import Lexicon, compile_words

PATH = op.default_vocabulary()
#: Letters, marks and spaces of several scripts and Unicode versions, contractions, the special token and parts of it.
PIECES = list("aZ é'sdmtvrel 12²½ªµ\n\t\r\x0b\x85\xa0\x1c İßΣς汉字ﬁ́_-!?Ᲊ՘😀𝟙") + ["<|endoftext|>", "<|endof", "text|>", "'ll", "'RE", " don't", "   ", "͸", "ꟍ", "한국어", " the", "The"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    made = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    return made + ["", "x" * 20000, "ab" * 5000, " " * 3000 + "\n" * 200, "<|endoftext|>" * 3, "word word " * 20000]


def test_merging_is_the_library(library, texts):
    v = op.vocabulary(PATH)
    for x in texts:
        assert [i for w in v.words(x) for i in v.ids(w.encode())] == library.encode(x, add_special_tokens=False).ids


def test_every_character_is_cut_like_the_library(library):
    v = op.vocabulary(PATH)
    for before in ("a", "1", "!", " ", "\n"):
        for c in range(0x600):
            x = before + chr(c) + "a" + chr(c) + " "
            assert v.words(x) == [x[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(x)]


@pytest.mark.parametrize("lexicon_words", [0, 40, 60_000])
def test_codec(spark, library, texts, lexicon_words):
    rows = [(i, x) for i, x in enumerate(texts)] + [(5, None), (None, "null id"), (5, "again"), (5, "again")]
    docs = spark.createDataFrame([(i, x, "clash", "n", 3) for i, x in rows], "doc_id long, text string, ids string, word string, id int").repartition(3)
    lexicon = op.fit(docs, PATH, lexicon_words=lexicon_words)
    coded = op.encode(docs, PATH, lexicon)
    want = sorted([(-1 if i is None else i, library.encode(x or "", add_special_tokens=False).ids) for i, x in rows], key=str)
    assert sorted([(-1 if r.doc_id is None else r.doc_id, r.ids) for r in coded.collect()], key=str) == want
    back = op.decode(coded, PATH).collect()
    assert sorted([(-1 if r.doc_id is None else r.doc_id, r.text) for r in back]) == sorted([(-1 if i is None else i, x or "") for i, x in rows])


def test_digests(spark, library):
    rows = [(1, "Hello there, it's <|endoftext|> done"), (2, None), (3, "")]
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op.round_trip(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()}
    for i, x in rows:
        ids = library.encode(x or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert got[i] == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_decoding_any_ids(spark, library):
    r = random.Random(4)
    lists = [[r.randrange(50257) for _ in range(r.randint(0, 30))] for _ in range(400)] + [None, [], [50256, 3]]
    got = op.decode(spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>"), PATH).collect()
    for row in got:
        assert row.text == library.decode(lists[row.doc_id] or [], skip_special_tokens=False)
    odd = spark.createDataFrame([(1, [None, 99_999_999, -1, 64])], "doc_id long, ids array<int>")
    assert op.decode(odd, PATH).first().text == library.decode([64])


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert op.round_trip(none, PATH).count() == 0


def test_lexicon_is_a_minimal_transducer(tmp_path):
    r = random.Random(5)
    words = {bytes(r.choice(b"abc") for _ in range(r.randint(1, 6))) for _ in range(300)}
    pairs = {w: tuple(r.randrange(3) for _ in range(r.randint(0, 4))) for w in words}
    path = str(tmp_path / "lexicon")
    compile_words(pairs.items(), path)
    asked = sorted(words) + [bytes(r.choice(b"abcd") for _ in range(r.randint(0, 8))) for _ in range(300)]
    buf = np.frombuffer(b"".join(asked), np.uint8)
    end = np.cumsum([len(w) for w in asked])
    ids, n = Lexicon(path).transduce(buf, end - [len(w) for w in asked], end, lambda i: np.array([100 + i], np.uint32))
    at = np.concatenate(([0], np.cumsum(n)))
    for i, w in enumerate(asked):
        assert tuple(ids[at[i] : at[i + 1]]) == pairs.get(w, (100 + i,))
    # Equal ends share their states: 26 words over one suffix need one path for it.
    sizes = compile_words([(bytes([65 + i]) + b"suffix", (i, 7)) for i in range(26)], path)
    assert sizes["states"] == 8 and sizes["arcs"] == 32
