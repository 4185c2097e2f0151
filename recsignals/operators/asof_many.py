"""As-of left join of one candidate table with many feature relations that share their keys.

Relations with the same key columns are one tagged table: a struct column per
relation, null in the rows of the others. It is written once, so no relation is
computed twice. Only times go through the search, one exchange per pass however many
relations there are: one running "last" per tag inside (keys, time bucket), one table
of carried times per (key, bucket) and one set of probes. Each tag's values are then
joined by (keys, time found) and go to the candidates, which are exchanged once.
Where keys with hot ones are told apart (:func:`asof_once`), only hot keys take that way: the candidates and all relations
of the other keys are one table, exchanged by key once.
The rules are those of :func:`recsignals.operators.asof.asof_join`: latest right
row strictly before (or at, if not ``strict``) the candidate's time, ties by the
greatest feature struct, null keys and times match nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsignals.functions.expr import micros
from recsignals.operators.frames import DEFAULT_BUCKET_US, bucket_of
from recsignals.operators.hot import Sizes
from recsignals.session import stage


@dataclass(frozen=True)
class Source:
    """A relation: its key columns in the order of the candidates' keys, its time, and the columns to attach."""

    rows: DataFrame
    on: tuple[str, ...]
    ts: str
    cols: tuple[str, ...]
    strict: bool = True


_PROBE, _CARRY = 0, -2


def tagged(sources: list[Source], names: list[str], width: int) -> DataFrame:
    """All relations as one table: keys, bucket, order, side and a struct (time, values) per tag."""
    parts = []
    for s in sources:
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*s.on, s.ts)])
        parts.append(s.rows.where(known).select(*[F.col(c).alias(k) for c, k in zip(s.on, names)], micros(s.ts).alias("__o"), F.lit(1 if s.strict else -1).alias("__side"),
                                                F.struct(*[F.col(c) for c in s.cols]).alias("__v")))
    kinds = [F.struct("__o", "__v") for _ in parts]
    types = [p.select(k.alias("m")).schema["m"].dataType for p, k in zip(parts, kinds)]
    full = [p.select(*names, "__o", "__side", *[(k if i == j else F.lit(None).cast(t)).alias(f"__m{j}") for j, (k, t) in enumerate(zip(kinds, types))]) for i, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, full).withColumn("__b", bucket_of(F.col("__o"), width))


def asof_many(left: DataFrame, on: list[str], left_ts: str, sources: list[Source], probes_from: DataFrame | None = None, bucket_us: int | None = None) -> DataFrame:
    """``left`` with the columns of all sources. ``probes_from``: a stored table with the same ``on`` and ``left_ts`` values
    as ``left``, if that is a long chain of joins."""
    width, names = int(bucket_us or DEFAULT_BUCKET_US), [f"__k{i}" for i in range(len(on))]
    _distinct_columns(left, sources)
    rights = stage(tagged(sources, names, width), "asof-tagged")
    tags = [f"__m{i}" for i in range(len(sources))]
    times = rights.select(*names, "__b", "__o", "__side", *[F.col(m)["__o"].alias(m) for m in tags])
    empty = [F.lit(None).cast("bigint").alias(m) for m in tags]

    src = left if probes_from is None else probes_from
    probes = src.select(*[F.col(c).alias(k) for c, k in zip(on, names)], micros(left_ts).alias("__o")).na.drop().distinct()
    probes = probes.withColumn("__b", bucket_of(F.col("__o"), width))

    # Carried times: the last of earlier buckets, per probed bucket and tag.
    totals = times.groupBy(*names, "__b").agg(*[F.max(m).alias(m) for m in tags]).withColumn("__side", F.lit(1))
    asked = probes.select(*names, "__b").distinct().select(*names, "__b", *empty, F.lit(0).alias("__side"))
    before = Window.partitionBy(*names).orderBy("__b", "__side").rowsBetween(Window.unboundedPreceding, 0)
    carry = totals.unionByName(asked).select(*names, "__b", "__side", *[F.last(m, ignorenulls=True).over(before).alias(m) for m in tags])
    carry = carry.where("__side = 0").select(*names, "__b", F.lit(-(2**63)).cast("bigint").alias("__o"), F.lit(_CARRY).alias("__side"), *tags)

    main = times.unionByName(probes.select(*names, "__b", "__o", F.lit(_PROBE).alias("__side"), *empty)).unionByName(carry)
    inside = Window.partitionBy(*names, "__b").orderBy("__o", "__side").rowsBetween(Window.unboundedPreceding, 0)
    answers = main.select(*names, "__o", "__side", *[F.max(m).over(inside).alias(m) for m in tags]).where(F.col("__side") == _PROBE)
    answers = stage(answers.select(*names, "__o", *tags), "asof-answers")

    out = left
    for i, (m, s) in enumerate(zip(tags, sources)):
        best = rights.where(F.col(m).isNotNull()).groupBy(*names, "__o").agg(F.max(F.col(m)["__v"]).alias(f"__v{i}"))
        best = best.withColumnsRenamed({**{k: f"__r{k}" for k in names}, "__o": "__found"})
        known = answers.where(F.col(m).isNotNull()).select(*[F.col(k).alias(f"__a{i}{k}") for k in names], F.col("__o").alias(f"__at{i}"), m)
        same = [F.col(f"__a{i}{k}") == F.col(f"__r{k}") for k in names] + [F.col(m) == F.col("__found")]
        known = known.join(best, reduce(lambda a, b: a & b, same)).select(*[f"__a{i}{k}" for k in names], f"__at{i}", f"__v{i}")
        here = [F.col(c) == F.col(f"__a{i}{k}") for c, k in zip(on, names)] + [micros(left_ts) == F.col(f"__at{i}")]
        out = out.join(known, reduce(lambda a, b: a & b, here), "left")
    return out.select(*[F.col(c) for c in left.columns], *[F.col(f"__v{i}")[c].alias(c) for i, s in enumerate(sources) for c in s.cols])


def _distinct_columns(left: DataFrame, sources: list[Source]) -> None:
    added = [c for s in sources for c in s.cols]
    twice = {c for c in added if added.count(c) > 1} | set(added) & set(left.columns)
    if twice:
        raise ValueError(f"columns come twice: {sorted(twice)}")


def asof_once(left: DataFrame, on: list[str], left_ts: str, sources: list[Source], sizes: Sizes, probes_from: DataFrame | None = None) -> DataFrame:
    """:func:`asof_many` by key sizes (:func:`recsignals.operators.hot.key_sizes` of ``left`` and of the logs the sources come
    from): for keys with few rows the candidates and the rows of all sources are exchanged by key once and sorted together; each
    candidate reads the last row of each source before it. Hot keys take :func:`asof_many`, with their rows of ``probes_from``."""
    _distinct_columns(left, sources)
    few, hot = sizes.split(left, on)
    apart = [sizes.split(s.rows, list(s.on)) for s in sources]
    names, rest = [f"__k{i}" for i in range(len(on))], [c for c in left.columns if c not in on]
    tags = [f"__m{i}" for i in range(len(sources))]

    def rows(df: DataFrame, keys, ts: str, side: int, own: dict) -> DataFrame:
        kinds = {"__l": kept} | dict(zip(tags, values))
        return df.select(*[F.col(c).cast(t).alias(k) for c, k, t in zip(keys, names, sizes.types)], micros(ts).alias("__o"), F.lit(side).alias("__side"),
                         *[own.get(n, F.lit(None).cast(t)).alias(n) for n, t in kinds.items()])

    inner = F.struct(*[F.col(c) for c in rest])
    packed = [F.struct(*[F.col(c) for c in s.cols]) for s in sources]
    kept = few.select(inner.alias("x")).schema["x"].dataType
    values = [r.select(v.alias("x")).schema["x"].dataType for (r, _), v in zip(apart, packed)]
    parts = [rows(few, on, left_ts, _PROBE, {"__l": inner})]
    for s, (r, _), v, m in zip(sources, apart, packed, tags):
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*s.on, s.ts)])
        parts.append(rows(r.where(known), s.on, s.ts, 1 if s.strict else -1, {m: v}))
    # each part by itself: one that lies by key already isn't moved, whatever the width of its features
    together = reduce(DataFrame.union, [p.repartition(*names) for p in parts])
    # ties of a source by the greatest values, as in asof_many
    w = Window.partitionBy(*names).orderBy("__o", "__side", *tags).rowsBetween(Window.unboundedPreceding, 0)
    found = together.select(*names, "__side", "__l", *[F.last(m, ignorenulls=True).over(w).alias(m) for m in tags]).where(F.col("__side") == _PROBE)
    place = {c: F.col(k).cast(dict(left.dtypes)[c]) for c, k in zip(on, names)}
    out = found.select(*[place[c].alias(c) if c in place else F.col("__l")[c].alias(c) for c in left.columns],
                       *[F.col(m)[c].alias(c) for m, s in zip(tags, sources) for c in s.cols])
    if hot is None:
        return out
    return out.unionByName(asof_many(hot, on, left_ts, [Source(r, s.on, s.ts, s.cols, s.strict) for s, (_, r) in zip(sources, apart)],
                                     None if probes_from is None else sizes.split(probes_from, on)[1]))
