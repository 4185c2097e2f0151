"""URL rules looked up in memory-mapped sorted digest arrays.

A rule is (host, path, verdict); it fits its host and all subdomains if the
url's path starts with the rule's. The rule strings' 64-bit xxhash keys are
sorted into an array file beside the full strings. Spark ships the file to each
executor, whose tasks map it. A url's candidates (host suffixes at label
borders, each with the path prefixes whose lengths occur in rules) are hashed,
found by binary search over a whole batch at once, and confirmed against the
stored string, so colliding keys never decide. The longest fitting rule wins,
equal lengths by the rule string; repeated rules by the verdict's name.

Scale: one map over (id, url), no shuffle. Distinct urls' hosts are expanded
once per batch. A rule list beyond ``block_bytes`` is cut by digest into several
files, each run against all urls; then the best answer per row is kept.

A null url or one without ``://`` has empty host and path, which no rule fits.
Repeated rows each get a row. Extra columns are kept out by name.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsignals.llm.common import buckets, ship_package

#: Rule bytes in one array file.
BLOCK_BYTES = 64 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def write_digests(rules: list[tuple[str, str, str]], path: str) -> None:
    """File: rule count, then sorted u8 keys, u8 string ends, u1 host lengths' block (u4), verdict numbers (u1), strings, verdict names."""
    rules = sorted(set(rules))
    text = [(h + p).encode() for h, p, _ in rules]
    names = sorted({v for _, _, v in rules})
    key = np.asarray([xxhash.xxh64_intdigest(t) for t in text], "<u8")
    order = np.argsort(key, kind="stable")
    ends = np.cumsum([len(text[i]) for i in order], dtype="<u8")
    host = np.asarray([len(rules[i][0].encode()) for i in order], "<u4")
    verdict = np.asarray([names.index(rules[i][2]) for i in order], "<u4")
    tail = "\n".join(names).encode()
    lengths = np.asarray(sorted({len(p.encode()) for _, p, _ in rules}), "<u8")
    with open(path, "wb") as f:
        f.write(np.asarray([len(rules), len(lengths), int(ends[-1]) if len(ends) else 0, len(tail)], "<u8").tobytes())
        for a in (key[order], ends, lengths, host, verdict):
            f.write(a.tobytes())
        f.write(b"".join(text[i] for i in order) + tail)


class Digests:
    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n, m, size, tail = (int(x) for x in raw[:32].view("<u8"))
        at = 32
        take = lambda count, kind: raw[at : at + count * np.dtype(kind).itemsize].view(kind)
        self.key = take(n, "<u8")
        at += 8 * n
        self.end = take(n, "<u8")
        at += 8 * n
        self.path_lengths = take(m, "<u8").tolist()
        at += 8 * m
        self.host = take(n, "<u4")
        at += 4 * n
        self.verdict = take(n, "<u4")
        at += 4 * n
        self.text = raw[at : at + size]
        self.names = raw[at + size : at + size + tail].tobytes().decode().split("\n")

    def string(self, i: int) -> bytes:
        return self.text[int(self.end[i - 1]) if i else 0 : int(self.end[i])].tobytes()

    def best(self, hosts: list[str], paths: list[str]) -> list[tuple[str, str] | None]:
        """The winning (rule, verdict) of each url."""
        cand, row, cut = [], [], []
        suffixes: dict[str, list[bytes]] = {}
        for r, (h, p) in enumerate(zip(hosts, paths)):
            if h not in suffixes:
                parts = h.split(".")
                suffixes[h] = [".".join(parts[i:]).encode() for i in range(len(parts))]
            p = p.encode()
            heads = [p[:n] for n in self.path_lengths if n <= len(p)]
            for s in suffixes[h]:
                for head in heads:
                    cand.append(s + head)
                    row.append(r)
                    cut.append(len(s))
        out: list[tuple[str, str] | None] = [None] * len(hosts)
        if not cand or not len(self.key):
            return out
        digest = np.fromiter(map(xxhash.xxh64_intdigest, cand), np.uint64, len(cand))
        lo, hi = np.searchsorted(self.key, digest), np.searchsorted(self.key, digest, side="right")
        won: list[tuple[int, bytes, str]] = [(-1, b"", "")] * len(hosts)
        for c in np.flatnonzero(hi > lo):
            for i in range(int(lo[c]), int(hi[c])):
                if self.host[i] == cut[c] and hosts[row[c]] and self.string(i) == cand[c]:
                    won[row[c]] = max(won[row[c]], (len(cand[c]), cand[c], self.names[self.verdict[i]]))
        return [(w[1].decode(), w[2]) if w[0] >= 0 else None for w in won]


@lru_cache(maxsize=2)
def _mapped(name: str) -> Digests:
    return Digests(SparkFiles.get(name))


def apply_rules(urls: DataFrame, rules, id_col="page_id", url_col="url", default="allow", block_bytes=BLOCK_BYTES) -> DataFrame:
    """rules: tuples (host, path, verdict), or a DataFrame with these columns. Returns id, host, path, rule, verdict."""
    spark = urls.sparkSession
    ship_package(spark)
    if isinstance(rules, DataFrame):
        r = rules.select("host", "path", "verdict").na.drop()
        n = buckets(r.agg(F.sum(F.length("host") + F.length("path") + 32)).first()[0] or 0, block_bytes, 1)
        parts = [[tuple(x) for x in r.filter(F.pmod(F.xxhash64("host", "path"), F.lit(n)) == b).collect()] for b in range(n)]
    else:
        parts = [list(rules)]
    host, path = host_and_path(urls[url_col])
    rows = urls.select(urls[id_col].alias(id_col), host.alias("host"), path.alias("path"))
    folder, found = tempfile.mkdtemp(prefix="digests-"), []  # the driver serves the files from here until it ends
    atexit.register(shutil.rmtree, folder, True)
    for part in parts:
        name = f"digests-{uuid.uuid4().hex}"
        write_digests(part, os.path.join(folder, name))
        spark.sparkContext.addFile(os.path.join(folder, name))

        def look_up(batches, name=name):
            digests = _mapped(name)
            for batch in batches:
                best = digests.best(batch.column("host").to_pylist(), batch.column("path").to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([b and b[0] for b in best], pa.string()), pa.array([b and b[1] for b in best], pa.string())], names=[*batch.schema.names, "rule", "listed"])

        keep = rows if len(parts) == 1 else rows.withColumn("rid", F.monotonically_increasing_id())
        found.append(keep.mapInArrow(look_up, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep.schema) + ", rule string, listed string"))
    if len(parts) == 1:
        out = found[0]
    else:
        best = F.max(F.struct(F.coalesce(F.length("rule"), F.lit(-1)).alias("n"), F.col("rule").alias("rule"), F.col("listed").alias("listed"))).alias("b")
        out = reduce(DataFrame.unionByName, found).groupBy("rid", id_col, "host", "path").agg(best).select(id_col, "host", "path", "b.rule", "b.listed")
    return out.select(id_col, "host", "path", "rule", F.coalesce("listed", F.lit(default)).alias("verdict"))
