"""Removal of every byte that a repeated string of ``span`` bytes covers.

Method: difference-cover suffix sorting, blockwise. Suffix buckets come from
content: in every ``span``-byte window the smallest hash of its ``gram``-byte
substrings is the window's anchor, so equal windows have equal anchors at equal
distance, and windows meet in the bucket of their anchor. An anchor's windows
are neighbours; together they are its context.

1. Per task, anchors with equal contexts are settled at once; one of them goes on.
2. Anchors meet by hash. One that occurs once has no repeated window. Equal
   contexts are repeated as a whole. Only contexts that differ under one anchor
   (where a repeat begins or ends) need their windows compared.
3. Those contexts are cut from the texts, and each bucket's windows are sorted as
   suffixes: by their bytes up to the next position of a difference-cover
   sample, long ties by the sample's precomputed ranks. Blocks of whole buckets
   bound the text and ranks that a task holds. Anchors with more contexts than
   ``HOT_CONTEXTS`` would not fit a block; their windows meet by hash instead,
   one of equal ones per task, so no task holds a hot bucket.
4. Covered runs meet their texts by (id, text hash).

What is shuffled are anchors (about two per hundred bytes), runs and the few
contexts, not texts, unless the runs are too large to broadcast.

Null text is empty. Repeated rows are two occurrences: each covers the other.
Strings are bytes of UTF-8 and never cross rows. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsignals.llm.common import BROADCAST_BYTES, buckets, id_back, keyed, stage
from recsignals.llm.difference_cover import PERIOD, CoverSample
from recsignals.llm.textbuf import U64, PrefixHash, blocks, give_back, mix, segments, text_view

#: Contexts of one anchor that are sorted in a block, and text bytes of a block.
HOT_CONTEXTS, BLOCK_TEXT = 5_000, 512 << 10
#: Anchors per task of step 2, context bytes per task of step 3; anchors that a task of step 1 holds and one of step 2 compares at a time.
BUCKET_ANCHORS, BUCKET_CONTEXTS, TASK_ANCHORS, MEET_ANCHORS = 300_000, 8 << 20, 150_000, 60_000
_SCAN_BYTES = 256 << 10


def find_anchors(buf: np.ndarray, off: np.ndarray, span: int, gram: int):
    """Per anchor: row, first window, number of windows, distance of the anchor from it, hash, context hash."""
    width = span - gram + 1
    n = len(buf) - span + 1
    none = np.zeros(0, np.int64)
    if n <= 0 or not (np.diff(off) >= span).any():
        return none, none, none, none, none.astype(U64), none.astype(U64)
    ph = PrefixHash(buf)
    x = ph._sum[gram:] - ph._sum[:-gram]
    x *= ph._down[: len(x)]
    x ^= x >> U64(29)
    x *= U64(0xBF58476D1CE4E5B9)
    x &= U64(0xFFFFFFFF00000000)
    x |= np.arange(len(x), dtype=U64)  # equal hashes: the first one
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    anchor = (x & U64(0xFFFFFFFF)).astype(np.int64)
    valid = np.zeros(n + 1, np.int32)  # windows that stay inside a row
    starts, ends = off[:-1], off[1:] - span + 1
    ok = ends > starts
    valid[starts[ok]] += 1
    valid[ends[ok]] -= 1
    valid = np.cumsum(valid[:-1]) > 0
    first = np.ones(n, bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
    a = np.flatnonzero(first)
    size = np.diff(np.append(a, n))
    keep = valid[a]
    a, size = a[keep], size[keep]
    p = anchor[a]
    row = np.searchsorted(off, a, side="right") - 1
    context = mix(ph.ranges(a, a + size - 1 + span) + (p - a).astype(U64))
    return row, a - off[row], size, p - a, ph.ranges(p, p + gram), context


def merge_runs(owner: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Union of runs per owner; touching ones become one."""
    if not len(owner):
        return owner, start, end
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    # Offsetting each owner past the one before lets one running maximum serve all.
    number = np.cumsum(np.concatenate(([0], owner[1:] != owner[:-1])))
    step = int(end.max()) + 2
    s, e = start + number * step, np.maximum.accumulate(end + number * step)
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > e[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)
    return owner[new], start[new], e[last] - number[last] * step


_RUN = "kid long, th long, start int, end int"
_ARRAYS = {"h": np.uint64, "c": np.uint64, "kid": np.int64, "th": np.int64, "start": np.int32, "size": np.uint8, "ahead": np.uint8, "done": np.uint8}
_PACKED = "bucket int, " + ", ".join(f"p_{k} binary" for k in _ARRAYS)


def _row_types(schema: str) -> list[tuple[str, pa.DataType]]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return [(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")]


def _batch(schema: str, cols: dict) -> pa.RecordBatch:
    """Columns by name; those not given are null."""
    n = len(next(iter(cols.values())))
    types = _row_types(schema)
    return pa.RecordBatch.from_arrays([pa.array(cols[c], t) if c in cols else pa.nulls(n, t) for c, t in types], names=[c for c, _ in types])


def _anchor_rows(rows: DataFrame, span: int, gram: int, parts: int) -> DataFrame:
    """Step 1: covered runs of the task, and packed anchors by bucket."""
    schema = f"{_RUN}, {_PACKED}"

    def settle(held: list[dict[str, np.ndarray]], owners: list[np.ndarray]):
        got, owner = {k: np.concatenate([x.pop(k) for x in held]) for k in list(held[0])}, np.concatenate(owners)
        order = np.lexsort((got["c"], got["h"]))
        h, c = got["h"][order], got["c"][order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        edge = np.flatnonzero(new)
        many = np.diff(np.append(edge, len(h))) > 1
        twice = order[np.repeat(many, np.diff(np.append(edge, len(h))))]
        if len(twice):
            o, s, e = merge_runs(owner[twice], got["start"][twice].astype(np.int64), got["start"][twice] + got["size"][twice].astype(np.int64) - 1 + span)
            at = np.searchsorted(owner, o)  # owners ascend
            yield _batch(schema, {"kid": got["kid"][at], "th": got["th"][at], "start": s.astype(np.int32), "end": e.astype(np.int32)})
        keep = order[edge]
        kept = {k: v[keep] for k, v in got.items()}
        kept["done"] = many.astype(np.uint8)
        bucket = (mix(kept["h"]) % U64(parts)).astype(np.int32)
        # Inside a bucket in document order: repeated ids and neighbouring starts compress well.
        by = np.lexsort((keep, bucket))
        cut = np.searchsorted(bucket[by], np.arange(parts + 1))
        full = [b for b in range(parts) if cut[b + 1] > cut[b]]
        yield _batch(schema, {"bucket": full} | {f"p_{k}": [kept[k][by[cut[b] : cut[b + 1]]].astype(t).tobytes() for b in full] for k, t in _ARRAYS.items()})

    def run(batches):
        held, owners, n, seen = [], [], 0, 0
        for batch, buf, off in blocks(batches, "text", _SCAN_BYTES):
            row, start, size, ahead, h, c = find_anchors(buf, off, span, gram)
            if len(row):
                kid, th = (batch.column(x).to_numpy()[row] for x in ("kid", "th"))
                held.append({"h": h, "c": c, "kid": kid, "th": th, "start": start.astype(np.int32), "size": size.astype(np.uint8), "ahead": ahead.astype(np.uint8)})
                owners.append(row + seen)
                n += len(row)
            seen += batch.num_rows
            if n > min(TASK_ANCHORS, 2 * BUCKET_ANCHORS):
                yield from settle(held, owners)
                held, owners, n = [], [], 0
                give_back()
        if held:
            yield from settle(held, owners)
        held.clear()
        give_back()

    return rows.mapInArrow(run, schema)


def _meet(packed: DataFrame, span: int) -> DataFrame:
    """Step 2: covered runs (need null), and contexts whose windows must be compared (need 1: not settled yet, 0: to compare with)."""
    schema = f"{_RUN}, h long, ahead int, need int, hot int"

    def meet(got: dict[str, np.ndarray]):
        order = np.lexsort((got["c"], got["h"]))
        got = {k: v[order] for k, v in got.items()}
        h, c = got["h"], got["c"]
        new_h = np.ones(len(h), bool)
        new_h[1:] = h[1:] != h[:-1]
        new = new_h.copy()
        new[1:] |= c[1:] != c[:-1]
        group = np.cumsum(new) - 1
        anchor = np.cumsum(new_h) - 1
        size = np.bincount(group)
        contexts = np.bincount(anchor[new])[anchor]
        repeated = size[group] > 1
        end = got["start"] + got["size"].astype(np.int32) - 1 + span
        base = {"kid": got["kid"], "th": got["th"], "start": got["start"], "end": end, "h": h.view(np.int64), "ahead": got["ahead"].astype(np.int32)}
        covered = repeated & (got["done"] == 0)
        ask = (contexts > 1) & new
        yield _batch(schema, {k: v[covered] for k, v in base.items()})
        need, hot = (~repeated & (got["done"] == 0)).astype(np.int32), (contexts > HOT_CONTEXTS).astype(np.int32)
        yield _batch(schema, {k: v[ask] for k, v in (base | {"need": need, "hot": hot}).items()})

    def run(table):
        # The arrays are views of the received columns; anchors of equal hash stay together.
        got = {k: text_view(table.column(f"p_{k}"))[0].view(t) for k, t in _ARRAYS.items()}
        parts = -(-len(got["h"]) // MEET_ANCHORS)
        part = ((mix(got["h"]) >> U64(32)) % U64(parts)).astype(np.int32)
        out = []
        for i in range(parts):
            own = np.flatnonzero(part == i)
            out += meet({k: v[own] for k, v in got.items()})
        del got, part, table
        give_back()
        return pa.Table.from_batches(out)

    return packed.groupBy("bucket").applyInArrow(run, schema)


def _with_texts(texts: DataFrame, per_text: DataFrame, bytes_: int, how: str) -> DataFrame:
    """Texts beside what is known of them; only a table of checked size is broadcast."""
    return texts.join(F.broadcast(per_text) if bytes_ <= BROADCAST_BYTES else per_text, ["kid", "th"], how)


_CONTEXT = {"h": np.int64, "kid": np.int64, "th": np.int64, "start": np.int32, "length": np.int32, "ahead": np.int32, "need": np.uint8}


def _contexts(beside: DataFrame, parts: int) -> DataFrame:
    """Step 3a: contexts cut from the texts, packed by bucket."""
    schema = "bucket int, " + ", ".join(f"p_{k} binary" for k in [*_CONTEXT, "text"])

    def run(batches):
        for batch, buf, off in blocks(batches, "text"):
            asks = batch.column("asks")
            if not len(asks.flatten()):
                continue
            row = np.repeat(np.arange(batch.num_rows), np.diff(asks.offsets.to_numpy()))
            f = asks.flatten()
            start, end, h, ahead, need = (f.field(k).to_numpy() for k in ("start", "end", "h", "ahead", "need"))
            got = {"h": h, "kid": batch.column("kid").to_numpy()[row], "th": batch.column("th").to_numpy()[row], "start": start, "length": end - start, "ahead": ahead, "need": need}
            bucket = (mix(h.astype(np.int64).view(U64)) % U64(parts)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(parts + 1))
            full = [b for b in range(parts) if cut[b + 1] > cut[b]]
            cols = {"bucket": full} | {f"p_{k}": [got[k][order[cut[b] : cut[b + 1]]].astype(t).tobytes() for b in full] for k, t in _CONTEXT.items()}
            cols["p_text"] = [buf[segments((off[row] + start)[o], got["length"][o].astype(np.int64))].tobytes() for b in full for o in [order[cut[b] : cut[b + 1]]]]
            yield _batch(schema, cols)

    return beside.mapInArrow(run, schema)


def _sort_blocks(packed: DataFrame, span: int) -> DataFrame:
    """Step 3b: sort each bucket's windows as suffixes; runs of windows that have an equal one."""

    def block(got: dict[str, np.ndarray], text: np.ndarray, first: np.ndarray):
        # Anchors stand at multiples of the period, so a bucket's equal windows share a residue.
        room = got["length"].astype(np.int64)
        lead = (-got["ahead"]) % PERIOD
        at = np.cumsum((lead + room + PERIOD - 1) // PERIOD * PERIOD)
        size = int(at[-1])
        at = np.concatenate(([0], at[:-1])) + lead
        flat = np.zeros(size + 3 * span, np.uint8)
        flat[segments(at, room)] = text[segments(first, room)]
        windows = room - span + 1
        pos = segments(at, windows)
        owner = np.repeat(np.arange(len(room)), windows)
        bucket = np.cumsum(np.concatenate(([0], got["h"][1:] != got["h"][:-1])))[owner]
        hit = np.zeros(len(pos), bool)
        for order, same in CoverSample(flat, size, span).equal_runs(pos, bucket):
            pair = np.flatnonzero(same)
            hit[order[pair]] = True
            hit[order[pair - 1]] = True
        hit &= got["need"][owner] == 1
        start = (pos - at[owner] + got["start"][owner])[hit]
        return merge_runs(owner[hit], start, start + span)

    def run(table):
        got = {k: text_view(table.column(f"p_{k}"))[0].view(t) for k, t in _CONTEXT.items()}
        text = text_view(table.column("p_text"))[0]
        first = np.cumsum(got["length"], dtype=np.int64) - got["length"]
        order = np.argsort(got["h"], kind="stable")
        got, first = {k: v[order] for k, v in got.items()}, first[order]
        edge = np.append(np.flatnonzero(np.diff(got["h"], prepend=got["h"][:1] - 1)), len(order))
        held = np.concatenate(([0], np.cumsum(got["length"], dtype=np.int64)))
        out, i = [], 0
        while i < len(edge) - 1:  # whole buckets up to the size of a block
            z = max(i + 1, int(np.searchsorted(held[edge], held[edge[i]] + BLOCK_TEXT, side="right")) - 1)
            own = slice(edge[i], edge[z])
            mine = {k: v[own] for k, v in got.items()}
            o, s, e = block(mine, text, first[own])
            out.append(_batch(_RUN, {"kid": mine["kid"][o], "th": mine["th"][o], "start": s.astype(np.int32), "end": e.astype(np.int32)}))
            i = z
        del got, first, text, table
        give_back()
        return pa.Table.from_batches(out)

    return packed.groupBy("bucket").applyInArrow(run, _RUN)


def _hot_windows(beside: DataFrame, span: int, parts: int) -> DataFrame:
    """Step 3 for anchors with very many contexts: their windows meet by hash; equal ones of a task are settled in it."""
    arrays = {"w": np.uint64, "kid": np.int64, "th": np.int64, "start": np.int32, "open": np.uint8}
    schema = f"{_RUN}, bucket int, " + ", ".join(f"p_{k} binary" for k in arrays)

    def send(batches):
        for batch, buf, off in blocks(batches, "text"):
            asks = batch.column("asks")
            if not len(asks.flatten()):
                continue
            row = np.repeat(np.arange(batch.num_rows), np.diff(asks.offsets.to_numpy()))
            f = asks.flatten()
            start, end, need = (f.field(k).to_numpy().astype(np.int64) for k in ("start", "end", "need"))
            n = end - start - span + 1
            owner = np.repeat(row, n)
            at = segments(start, n)
            where = off[owner] + at
            w, need = PrefixHash(buf).ranges(where, where + span), np.repeat(need, n)
            order = np.argsort(w, kind="stable")
            new = np.ones(len(w), bool)
            new[1:] = w[order][1:] != w[order][:-1]
            count = np.diff(np.append(np.flatnonzero(new), len(w)))
            kid, th = batch.column("kid").to_numpy(), batch.column("th").to_numpy()
            twice = order[np.repeat(count > 1, count)]
            if len(twice):
                o, s, e = merge_runs(owner[twice], at[twice], at[twice] + span)
                yield _batch(schema, {"kid": kid[o], "th": th[o], "start": s.astype(np.int32), "end": e.astype(np.int32)})
            one = order[new]
            got = {"w": w[one], "kid": kid[owner[one]], "th": th[owner[one]], "start": at[one], "open": ((count == 1) & (need[one] == 1))}
            bucket = (w[one] % U64(parts)).astype(np.int32)
            by = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[by], np.arange(parts + 1))
            full = [b for b in range(parts) if cut[b + 1] > cut[b]]
            yield _batch(schema, {"bucket": full} | {f"p_{k}": [got[k][by[cut[b] : cut[b + 1]]].astype(t).tobytes() for b in full] for k, t in arrays.items()})

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        got = {k: np.frombuffer(b"".join(pdf[f"p_{k}"]), t) for k, t in arrays.items()}
        _, group, count = np.unique(got["w"], return_inverse=True, return_counts=True)
        hit = (count[group] > 1) & (got["open"] == 1)
        return pd.DataFrame({"kid": got["kid"][hit], "th": got["th"][hit], "start": got["start"][hit], "end": got["start"][hit] + span})

    sent = stage(beside.mapInArrow(send, schema), "op4-hot")
    met = sent.filter("bucket is not null").drop("kid", "th", "start", "end").repartition(parts, "bucket").groupBy("bucket").applyInPandas(meet, _RUN)
    return sent.filter("kid is not null").select("kid", "th", "start", "end").unionByName(met)


def repeated_runs(texts: DataFrame, span: int, gram: int) -> DataFrame:
    """(kid, th, runs): the merged covered runs of every text that has any; staged."""
    volume = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = buckets(2 * volume / (span - gram + 2), BUCKET_ANCHORS)
    first = stage(_anchor_rows(texts, span, gram, parts), "op4-anchors")
    packed = first.filter("bucket is not null").select([c.split()[0] for c in _PACKED.split(", ")]).repartition(parts, "bucket")
    met = stage(_meet(packed, span), "op4-met")
    runs = [first.filter("bucket is null").select("kid", "th", "start", "end"), met.filter("need is null").select("kid", "th", "start", "end")]
    for hot in (0, 1):
        asked = met.filter(F.col("hot") == hot)
        total = asked.agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("bytes")).first()
        if not total["n"]:
            continue
        asks = asked.groupBy("kid", "th").agg(F.collect_list(F.struct("start", "end", "h", "ahead", "need")).alias("asks"))
        beside = _with_texts(texts, asks, total["n"] * 96, "inner").select("kid", "th", "asks", "text")
        if hot:
            runs.append(_hot_windows(beside, span, buckets(total["bytes"] * 16, BUCKET_CONTEXTS)))
        else:
            cut = buckets(total["bytes"], BUCKET_CONTEXTS)
            runs.append(_sort_blocks(_contexts(beside, cut).repartition(cut, "bucket"), span))
    every = runs[0]
    for r in runs[1:]:
        every = every.unionByName(r)

    def unite(batches):
        for batch in batches:
            lists = batch.column("runs")
            flat = lists.flatten()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            o, s, e = merge_runs(owner, flat.field("start").to_numpy().astype(np.int64), flat.field("end").to_numpy().astype(np.int64))
            offsets = np.searchsorted(o, np.arange(batch.num_rows + 1)).astype(np.int32)
            merged = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32))], names=["start", "end"]))
            yield pa.RecordBatch.from_arrays([batch.column("kid"), batch.column("th"), merged], names=["kid", "th", "runs"])

    grouped = every.groupBy("kid", "th").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    return stage(grouped.mapInArrow(unite, "kid long, th long, runs array<struct<start:int,end:int>>"), "op4-runs")


def dedup(docs: DataFrame, id_col="doc_id", text_col="text", span=200, gram=96, extra: tuple[str, ...] = (), as_text=False) -> DataFrame:
    """id, kept (the remaining bytes), n_bytes and runs (removed, merged, in order) per row, and the columns of ``extra``.

    ``as_text``: kept is a string; a character of which only some bytes were cut goes whole.
    """
    texts = keyed(docs, id_col, text_col)
    runs = repeated_runs(texts, span, gram)
    total = runs.agg(F.count("*").alias("n"), F.sum(F.size("runs")).alias("runs")).first()
    rows = keyed(docs, id_col, text_col, extra)
    beside = _with_texts(rows, runs, 48 * (total["n"] or 0) + 16 * (total["runs"] or 0), "left").select("kid", "text", "runs", *extra)

    def cut(batches):
        for batch, buf, off in blocks(batches, "text", _SCAN_BYTES):
            lists = batch.column("runs")
            edge = np.zeros(len(buf) + 1, np.int32)
            n = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            base = np.repeat(off[:-1], n)
            np.add.at(edge, flat.field("start").to_numpy() + base, 1)
            np.add.at(edge, flat.field("end").to_numpy() + base, -1)
            keep = np.cumsum(edge[:-1]) == 0
            left = np.concatenate(([0], np.cumsum(keep)))[off].astype(np.int32)
            kept = pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(left), pa.py_buffer(buf[keep])])
            if as_text:
                kept = pa.array([x.as_py().decode("utf-8", "ignore") for x in kept], pa.string())
            cells = {"kept": kept, "n_bytes": pa.array(np.diff(off), pa.int64()), "runs": lists}
            yield pa.RecordBatch.from_arrays([cells.get(c, batch.column(c) if c in batch.schema.names else None) for c in names], names=names)

    kinds = {"kid": "bigint", "kept": "string" if as_text else "binary", "n_bytes": "bigint", "runs": "array<struct<start:int,end:int>>"} | {c: rows.schema[c].dataType.simpleString() for c in extra}
    names = list(kinds)
    out = beside.mapInArrow(cut, ", ".join(f"`{c}` {k}" for c, k in kinds.items()))
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    return out.select(id_back().alias(id_col), "kept", "n_bytes", F.coalesce("runs", none).alias("runs"), *extra)


def summary(found: DataFrame, id_col="doc_id") -> DataFrame:
    removed = F.aggregate("runs", F.lit(0).cast("long"), lambda acc, r: acc + r["end"] - r["start"])
    return found.select(id_col, "n_bytes", removed.alias("n_removed"), F.size("runs").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
