"""In-session and target operators (C9, C27, C29-C31, C36-C39; O4, O8, A7, A11).

Whole-session statistics are partial aggregations joined back and ranks run
inside bands of values, so a large session is never sorted in one task
(:mod:`recsignals.operators.groups`).  Negative downsampling keeps the
``limit`` smallest hashes per session with a salted two-stage top-k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsignals.operators.groups import SMALL_GROUP, _ns_join, band, group_stats, rank_in_bands, rank_many, ranks_in_small_groups, split_by_size


def candidate_count(df: DataFrame, session: str, item: str) -> DataFrame:
    """``session_candidate_count`` = non-null items in the session."""
    return group_stats(df, [session], [F.count(item).alias("session_candidate_count")])


def session_stats(df: DataFrame, session: str, item: str, measures: dict[str, str], price: str, row_id: str,
                  small: int = SMALL_GROUP) -> DataFrame:
    """Per candidate: session size, cheapest / most expensive flags, session
    avg/std/min/max of each measure, ascending SQL rank and % difference from
    the session mean (C27; W19-W23).  ``measures``: short name -> column.
    ``row_id`` is unique. ``df`` is read several times: pass a staged table if it is
    costly. Sessions of at most ``small`` rows take one exchange and windows; larger ones
    partial aggregates joined back and ranks in bands."""
    aggs = {"session_item_count": F.count(item)}
    for short, c in measures.items():
        aggs |= {f"session_avg_{short}": F.avg(c), f"session_std_{short}": F.stddev_samp(c), f"session_min_{short}": F.min(c),
                 f"session_max_{short}": F.max(c), f"__n_{short}": F.count(c)}
    ranks = [(f"__r_{short}", session, c, True) for short, c in measures.items()]
    few, many = split_by_size(df, session, small)
    few = ranks_in_small_groups(few.select("*", *[a.over(Window.partitionBy(session)).alias(n) for n, a in aggs.items()]), ranks)
    d = few.unionByName(group_stats(rank_in_bands(many, row_id, ranks), [session], [a.alias(n) for n, a in aggs.items()]))
    ps = [k for k, v in measures.items() if v == price][0]
    d = d.withColumns({
        "is_cheapest_in_session": F.when(F.col(price) == F.col(f"session_min_{ps}"), 1).otherwise(0),
        "is_most_expensive_in_session": F.when(F.col(price) == F.col(f"session_max_{ps}"), 1).otherwise(0)})
    for short, c in measures.items():
        d = d.withColumn(f"{short}_rank", F.coalesce(f"__r_{short}", F.col(f"__n_{short}") + 1))  # nulls share the last rank
        d = d.withColumn(f"{short}_diff_percent",
                         100.0 * (F.col(c) - F.col(f"session_avg_{short}")) / F.nullif(F.col(f"session_avg_{short}"), F.lit(0)))
    return d.drop(*[f"__{k}_{short}" for k in "rn" for short in measures])


def weighted_target(df: DataFrame, weights: dict[str, float], alias: str = "target") -> DataFrame:
    """Weighted sum of label columns."""
    e = F.lit(0.0)
    for c, w in weights.items():
        e = e + F.col(c) * w
    return df.withColumn(alias, e)


def downsample_negatives(df: DataFrame, session: str, labels: list[str], limit: int,
                         order: str | None = None, seed: int = 42, salts: int = 64) -> DataFrame:
    """Sessions with more than ``limit`` zero-label rows keep every positive
    row and the ``limit`` zero-label rows first in ``order`` (default: a
    seeded xxhash64 of the row), so the sample is deterministic (C31, O4).

    Exact distributed top-k: each (session, salt) keeps its own first
    ``limit`` rows, then the at most ``salts * limit`` survivors of a session
    are ranked again."""
    tgt = sum((F.col(c) for c in labels), F.lit(0))
    key = F.col(order) if order else F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns])
    d = df.withColumn("__neg", tgt == 0).withColumn("__o", key)
    neg = d.where(F.col("__neg")).withColumn("__salt", F.pmod(F.xxhash64(F.col("__o")), F.lit(salts)))
    w1 = Window.partitionBy(session, "__salt").orderBy("__o")
    first = neg.withColumn("__r1", F.row_number().over(w1)).where(F.col("__r1") <= limit)
    w2 = Window.partitionBy(session).orderBy("__o", "__salt", "__r1")
    kept = first.withColumn("__r", F.row_number().over(w2)).where(F.col("__r") <= limit)
    kept = kept.drop("__salt", "__r1", "__r")
    return d.where(~F.col("__neg")).unionByName(kept).drop("__neg", "__o")


def time_split(df: DataFrame, ts: str) -> tuple[DataFrame, DataFrame]:
    """(train, validation): validation is the last time of the data."""
    last = df.agg(F.max(ts).alias("__last"))
    d = df.crossJoin(F.broadcast(last))  # one row
    return (d.where(F.col(ts) < F.col("__last")).drop("__last"),
            d.where(F.col(ts) == F.col("__last")).drop("__last"))


def blend_scores(a: DataFrame, b: DataFrame, keys: list[str], col_a: str, col_b: str,
                 weights=(0.5, 0.5), alias: str = "prediction") -> DataFrame:
    """Inner join of two score sets and their weighted mean."""
    return a.join(b, keys, "inner").withColumn(alias, F.col(col_a) * weights[0] + F.col(col_b) * weights[1])


def ranked_list(df: DataFrame, session: str, item: str, score: str, alias: str = "prediction") -> DataFrame:
    """One row per session: items by descending score (ties by item),
    joined with spaces (C38, A11).  The output row holds the whole session
    by definition."""
    arr = F.array_sort(F.collect_list(F.struct((-F.col(score)).alias("s"), F.col(item).cast("string").alias("i"))))
    return df.groupBy(session).agg(F.array_join(F.transform(arr, lambda e: e["i"]), " ").alias(alias))


def session_rank(df: DataFrame, session: str, item: str, score: str, alias: str = "rank") -> DataFrame:
    """Position of each candidate in its session by descending score, ties
    by the number ``item`` (C36). Scores are ordered inside bands of the score
    and tied items inside bands of the item, so not even one score for a whole
    session sorts it in one task."""
    cell = [session, "__band", "__v", "__item"]
    d = df.withColumn("__v", -F.col(score).cast("double")).withColumns({"__band": band(F.col("__v")), "__item": band(F.col(item))})
    cells = d.groupBy(*cell).agg(F.count(F.lit(1)).alias("__c"))
    first = lambda w: F.coalesce(F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bands = cells.groupBy(session, "__band").agg(F.sum("__c").alias("__c"))
    bands = bands.select(session, "__band", first(Window.partitionBy(session).orderBy("__band")).alias("__below"))
    before = first(Window.partitionBy(session, "__band").orderBy(F.col("__v").asc_nulls_last(), "__item"))
    cells = _ns_join(cells.withColumn("__before", before), bands, [session, "__band"]).drop("__c")
    out = _ns_join(d.withColumn("__in", F.rank().over(Window.partitionBy(*cell).orderBy(item))), cells, cell)
    return out.withColumn(alias, (F.col("__in") + F.col("__before") + F.col("__below")).cast("bigint")).drop(*cell[1:], "__in", "__before", "__below")


def auc_ranksum(df: DataFrame, score: str, label: str) -> DataFrame:
    """ROC AUC by the rank-sum formula with average ranks for ties (C39); null
    when a class is empty. Distinct scores are ordered inside bands of the
    score; only the bands' totals, a few thousand rows whatever the input, are
    ordered as a whole."""
    c = df.groupBy(score).agg(F.sum(F.when(F.col(label) > 0, 1).otherwise(0)).alias("__p"),
                              F.count(F.lit(1)).alias("__n")).withColumn("__band", band(F.col(score)))
    totals = c.groupBy("__band").agg(F.sum("__n").alias("__t"))
    below = totals.select("__band", (F.coalesce(F.sum("__t").over(Window.orderBy("__band").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("__before"))
    w = Window.partitionBy("__band").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumn("__in", F.coalesce(F.sum("__n").over(w), F.lit(0))).join(F.broadcast(below), "__band")
    c = c.withColumn("__avg_rank", F.col("__in") + F.col("__before") + (F.col("__n") + 1) / 2.0)
    t = c.agg(F.sum(F.col("__p") * F.col("__avg_rank")).alias("rs"), F.sum("__p").alias("np"),
              F.sum(F.col("__n") - F.col("__p")).alias("nn"))
    pairs = F.nullif(F.col("np") * F.col("nn"), F.lit(0))
    return t.select(((F.col("rs") - F.col("np") * (F.col("np") + 1) / 2.0) / pairs).alias("auc"),
                    F.col("np").alias("n_pos"), F.col("nn").alias("n_neg"))


def rank_votes(raw: dict[str, list[str]], ratios: dict[str, list[str]]) -> dict[str, int]:
    """How often each column's rank counts in the mean and median rank: a raw
    column once for either place in every ordered pair of its table's columns,
    a ratio once."""
    votes = {}
    for table, columns in raw.items():
        votes |= {f"{table}_{c}": 2 * (len(columns) - 1) for c in columns}
        votes |= {f"{table}_{r}": 1 for r in ratios.get(table, [])}
    return {c: n for c, n in votes.items() if n}


def session_ranks(df: DataFrame, session: str, row_id: str, votes: dict[str, int],
                  scores: dict[str, dict[str, float]], table_weights: dict[str, float],
                  ascending: list[str] = (), descending: list[str] = ()) -> DataFrame:
    """In-session ranks (C10; W33, W34; F12): of the columns in ``votes`` and of
    one weighted score per table (``scores``: table -> column -> weight), all
    descending; of ``ascending`` and ``descending`` columns besides. Ranks are
    shared by ties; nulls stay null. Adds ``rank_{session}_{column}`` for each,
    and the mean and median of the voting ranks with their multiplicity and the
    table-weighted total score. A column that is missing is an error."""
    from recsignals.functions.expr import array_mean, array_median, nz_sum

    needed = {*votes, *ascending, *descending, *(c for w in scores.values() for c in w)}
    if needed - set(df.columns):
        raise ValueError(f"missing columns: {sorted(needed - set(df.columns))}")
    df = df.withColumns({f"{t}_weighted_score": nz_sum([F.col(c) * w for c, w in by.items()]) for t, by in scores.items()})
    votes = {f"{t}_weighted_score": 1 for t in scores} | votes
    name = lambda c: f"rank_{session}_{c}"
    down = list(dict.fromkeys([*votes, *descending]))
    df = rank_many(df, row_id, [(name(c), session, c, False) for c in down] + [(name(c), session, c, True) for c in ascending])
    cast = [name(c) for c, n in votes.items() for _ in range(n)]
    return df.withColumns({
        "avg_content_search_and_sitewide_rank": array_mean(cast),
        "median_content_search_and_sitewide_rank": array_median(cast),
        "total_content_search_and_sitewide_weighted_score": nz_sum([F.col(f"{t}_weighted_score") * w for t, w in table_weights.items() if t in scores])})
