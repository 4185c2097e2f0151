"""Byte-level BPE encoding and decoding of whole texts through a lexicon transducer.

Method. Texts are cut into the vocabulary's pre-tokens (letters, digits, other
marks, each with a space before it, white space, contractions). One pass counts
the pre-tokens of all texts; the ``lexicon_words`` most frequent ones and their
ids become a minimal acyclic transducer with shared suffixes (``lexicon.py``),
shipped by Spark as one file that every worker memory-maps. The second pass walks
the distinct pre-tokens of a block through it at once; one that the lexicon lacks
is merged exactly, lowest rank first, leftmost first, as the vocabulary demands.
So the lexicon's size changes cost only, never ids.

Decoding gathers each id's bytes and reads them as UTF-8; bytes that aren't valid
UTF-8 (ids cut inside a character) become U+FFFD, unknown ids nothing.

The vocabulary file's special tokens are matched in texts before all else, as the
tokenizers library does. Null texts are empty texts, which have no ids; null ids
of documents stay null; repeated rows each get a row; columns other than the id
and the text are not read. No table, shard or group passes through the driver but
the bounded lexicon.
"""

from __future__ import annotations

import atexit
import heapq
import json
import os
import re
import shutil
import tempfile
import unicodedata
import uuid
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsignals.llm.common import ship_package
from recsignals.llm.lexicon import Lexicon, compile_words
from recsignals.llm.textbuf import blocks, segments
from recsignals.llm.tokens import byte_alphabet

#: Words of the lexicon, and the longest one in bytes (longer pre-tokens are always merged).
LEXICON_WORDS, LONGEST_WORD = 60_000, 48
#: Distinct pre-tokens that a counting task holds, and merged pre-tokens that a worker remembers.
HELD_WORDS, CACHED_WORDS = 300_000, 500_000
#: Text bytes whose distinct pre-tokens are looked up at a time.
BLOCK_BYTES = 4 << 20
#: From here on, Unicode versions differ in which characters are letters: texts with such characters are cut by the library.
COMMON_CHARS = 0x530
#: A merge's rank and the id that it makes share a number; none is larger than all.
ID_BITS, ID_MASK, NO_MERGE = 32, (1 << 32) - 1, 1 << 62


def _classes() -> tuple[str, str, str]:
    """Letters, numbers and white space below ``COMMON_CHARS``, as the inside of a character class."""
    kinds = {"L": "", "N": "", "S": ""}
    for c in map(chr, range(COMMON_CHARS)):
        kind = "S" if c in "\t\n\x0b\x0c\r \x85\xa0" else unicodedata.category(c)[0]
        if kind in kinds and not (kind == "S" and not c.isspace()):
            kinds[kind] += re.escape(c)
    return kinds["L"], kinds["N"], kinds["S"]


def _cutter():
    letter, number, space = _classes()
    return re.compile(f"'(?:[sdmt]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+").findall


class Vocabulary:
    """Ranks, bytes of each id, special tokens and the cut into pre-tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: b for b, c in byte_alphabet().items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        ids = spec["model"]["vocab"]
        self.single = {back[t]: i for t, i in ids.items() if len(t) == 1}
        #: (left id, right id) -> rank and merged id in one number
        self.merge = {(ids[a], ids[b]): rank << ID_BITS | ids[a + b] for rank, (a, b) in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        content = {i: bytes(back[c] for c in t) for t, i in ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.content = [content.get(i, b"") for i in range(max(content, default=-1) + 1)]
        # Longest first at the same place, as the library matches them.
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._cut, self._library = _cutter(), Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str

    def _plain(self, text: str) -> list[str]:
        if text.isascii() or max(text) < chr(COMMON_CHARS):
            return self._cut(text)
        return [text[a:b] for _, (a, b) in self._library(text)]

    def words(self, text: str) -> list[str]:
        """All pre-tokens, special tokens among them; joined they are the text."""
        if self._special is None or not self._special.search(text):
            return self._plain(text) if text else []
        out, at = [], 0
        for m in self._special.finditer(text):
            if m.start() > at:
                out += self._plain(text[at : m.start()])
            out.append(m.group())
            at = m.end()
        return out + (self._plain(text[at:]) if at < len(text) else [])

    def ids(self, word: bytes) -> list[int]:
        """Ids of one pre-token by merging: the pair of lowest rank first, the leftmost among equals."""
        special = self.special.get(word.decode("utf-8")) if word[:1] == b"<" else None
        if special is not None:
            return [special]
        ids: list[int | None] = [self.single[b] for b in word]
        return self._merge_short(ids) if len(ids) <= 32 else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        look = self.merge.get
        found = [look(pair, NO_MERGE) for pair in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best == NO_MERGE:
                break
            i = found.index(best)
            ids[i : i + 2] = [best & ID_MASK]
            del found[i]
            if i:
                found[i - 1] = look((ids[i - 1], ids[i]), NO_MERGE)
            if i < len(found):
                found[i] = look((ids[i], ids[i + 1]), NO_MERGE)
        return ids

    def _merge_long(self, ids: list[int | None]) -> list[int]:
        """The same with a heap of pairs, for words of any length."""
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        merge, heap = self.merge, []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(ids) and (found := merge.get((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (found >> ID_BITS, i, j, ids[i], ids[j], found & ID_MASK))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            _, i, j, a, b, merged = heapq.heappop(heap)
            if ids[i] != a or after[i] != j or ids[j] != b:
                continue
            ids[i], ids[j] = merged, None
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [x for x in ids if x is not None]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def _lexicon(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


@lru_cache(maxsize=2)
def _merged(path: str) -> dict[bytes, bytes]:
    """Pre-tokens that this worker has merged, and their ids."""
    return {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def word_counts(docs: DataFrame, path: str, text_col="text") -> DataFrame:
    """(word, n): how often each pre-token of at most ``LONGEST_WORD`` bytes occurs in all texts."""

    def run(batches):
        cut, held = vocabulary(path).words, Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for x in batch.column(0):
                held.update(cut(x.as_py() or ""))
                if len(held) > HELD_WORDS:
                    yield flush()
        yield flush()

    ship_package(docs.sparkSession)
    parts = docs.select(docs[text_col].cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return parts.filter(F.octet_length("word") <= LONGEST_WORD).groupBy("word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, path: str, text_col="text", lexicon_words=LEXICON_WORDS) -> str:
    """Compile the most frequent pre-tokens of all texts; returns the name of the shipped lexicon file."""
    spark, vocab = docs.sparkSession, vocabulary(path)
    top = word_counts(docs, path, text_col).orderBy(F.desc("n"), "word").limit(lexicon_words).select("word").collect()
    words = [r["word"].encode() for r in top]
    folder = tempfile.mkdtemp(prefix="lexicon-")  # the driver serves the file from here until it ends
    atexit.register(shutil.rmtree, folder, True)
    name = f"lexicon-{uuid.uuid4().hex}"
    compile_words(((w, vocab.ids(w)) for w in words), os.path.join(folder, name))
    spark.sparkContext.addFile(os.path.join(folder, name))
    return name


def encode(docs: DataFrame, path: str, lexicon: str | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, ids array<int>) of every text; fits a lexicon on the same texts if none is given."""
    lexicon = lexicon or fit(docs, path, text_col)

    def run(batches):
        vocab, known, merged = vocabulary(path), _lexicon(lexicon), _merged(path)
        for batch, _, _ in blocks(batches, "text", BLOCK_BYTES):
            cut = [vocab.words(x.as_py() or "") for x in batch.column("text")]
            per_row = np.array([len(w) for w in cut], np.int64)
            numbers: dict[str, int] = {}
            at = np.array([numbers.setdefault(w, len(numbers)) for row in cut for w in row], np.int64)
            distinct = [w.encode() for w in numbers]
            end = np.cumsum(np.fromiter(map(len, distinct), np.int64, len(distinct)))
            first = np.concatenate(([0], end))[:-1]

            def unseen(i: int) -> np.ndarray:
                w = distinct[i]
                if w not in merged:
                    if len(merged) >= CACHED_WORDS:
                        merged.clear()
                    merged[w] = np.array(vocab.ids(w), np.uint32).tobytes()
                return np.frombuffer(merged[w], np.uint32)

            ids, n = known.transduce(np.frombuffer(b"".join(distinct), np.uint8), first, end, unseen)
            start = np.concatenate(([0], np.cumsum(n)))
            edge = np.concatenate(([0], np.cumsum(n[at])))[np.concatenate(([0], np.cumsum(per_row)))]
            ids = ids[segments(start[at], n[at])]
            lists = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists], names=[id_col, "ids"])

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema['id'].dataType.simpleString()}, ids array<int>")


def decode(coded: DataFrame, path: str, id_col="doc_id", ids_col="ids", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, text, the ``keep`` columns): the text of every id list; null lists and null ids count as nothing."""

    def run(batches):
        content = vocabulary(path).content
        size = np.array([len(c) for c in content] + [0], np.int64)
        start = np.concatenate(([0], np.cumsum(size)[:-1]))
        pool = np.frombuffer(b"".join(content), np.uint8)
        for batch in batches:
            column = batch.column("ids")
            counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = column.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = np.where((ids >= 0) & (ids < len(content)), ids, len(content))
            edge = np.concatenate(([0], np.cumsum(counts)))
            texts = []
            for a, z in zip(edge[:-1], edge[1:]):
                own = ids[a:z]
                texts.append(pool[segments(start[own], size[own])].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string()), *[batch.column(c) for c in keep]], names=[id_col, "text", *keep])

    rows = coded.select(coded[id_col].alias("id"), coded[ids_col].cast("array<int>").alias("ids"), *[coded[c] for c in keep if c != "ids"])
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"`{id_col}` {kinds['id']}, text string" + "".join(f", `{c}` {kinds[c]}" for c in keep))


def round_trip(docs: DataFrame, path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """Digest columns of the ids of every text and of the text decoded from them."""
    both = decode(encode(docs, path, None, id_col, text_col), path, id_col, keep=("ids",))
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select(id_col, F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
