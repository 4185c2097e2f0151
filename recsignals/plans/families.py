"""Feature families as relations: keys, time and columns, so that many can be attached to one candidate table at once.

A family says how its relation is built, which candidate columns it is keyed by
and which features come out. :func:`attach` groups the asked families by (keys,
time): each group is one tagged as-of join, whatever the number of relations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsignals.operators import affinity as A
from recsignals.operators.asof_many import Source, asof_once
from recsignals.operators.hot import key_sizes
from recsignals.operators.history import history_columns, history_table, rolling_columns, rolling_table
from recsignals.plans import params as P
from recsignals.plans import q_affinity as QA
from recsignals.plans import q_counters as QC
from recsignals.session import stage


@dataclass(frozen=True)
class Family:
    """``query`` is the registered query that computes the family by itself; its statement defines the features."""

    query: str
    on: tuple[str, ...]
    ts: str
    right_ts: str
    relation: Callable  # (spark, candidates) -> DataFrame with the keys' columns, right_ts and the carried columns; with ``log`` (spark, candidates, sizes)
    features: tuple[str, ...]
    carried: tuple[str, ...] = ()  # columns brought by the join, where they aren't the features
    finish: Callable | None = None  # joined candidates -> with the features
    strict: bool = True
    fill: float | None = None
    log: Callable | None = None  # (spark, candidates) -> stored rows that the relation is made from and their key columns

    @property
    def joined(self) -> tuple[str, ...]:
        return self.carried or self.features


LEVELS = {"l1": "level1", "l2": "level2", "leaf": "leaf"}
SITE = ["total_click", "total_cart", "total_order", "total_fav"]
SEARCH = ["total_search_impression", "total_search_click"]


def _counters(name: str, ts: str) -> Family:
    on, right_ts, relation, columns, log = QC.COUNTERS[name]
    return Family(name, on, ts, right_ts, lambda spark, cand, sizes: relation(spark, sizes), columns, log=lambda spark, cand: log(spark))


def _log(view: str, *keys: str) -> Callable:
    return lambda spark, cand: (spark.table(view), list(keys))


def _item(name: str, ts: str, relation: Callable, features, right_ts: str = "date", **kw) -> Family:
    return Family(name, ("item_id",), ts, right_ts, relation, tuple(features), **kw)


_ITEM_LOG = _log("o_item_log", "item_id")


def _by_item(ts: str) -> list[Family]:
    """Families that any candidate table with ``item_id`` can have; ``ts`` is its time for daily logs."""
    velocity = lambda spark, cand, sizes: A.popularity_velocity(spark.table("o_item_log"), "item_id", "date", sizes=sizes)

    def ranks(spark, cand, sizes):
        log = spark.table("o_item_log")
        return A.category_popularity_rank(log, spark.table("o_item_meta"), "item_id", "date", {"leaf": "leaf", "l2": "level2", "l1": "level1"}, sizes=sizes, days=key_sizes((log, ["date"])))

    return [_counters("q_item_ctr_3d7d", ts), _counters("q_item_site_ratios", ts), _item("q_velocity", ts, velocity, QA._ALLT + QA._VEL, log=_ITEM_LOG), _item("q_category_rank", ts, ranks, QA._RANKS, log=_ITEM_LOG)]


def _affinity(ts: str) -> Family:
    """User x category conversion from the candidates' own earlier labels; needs the categories on the candidates."""
    def relation(spark, cand, sizes):
        return A.category_affinity(cand.select("user_id", ts, "clicked", "ordered", *LEVELS.values()), "user_id", ts, LEVELS, sizes=key_sizes((cand, ["user_id"])))

    levels = list(LEVELS.values())
    return Family("q_category_affinity", ("user_id", *levels), ts, ts, relation, tuple(QA._AFF_OUT), log=lambda spark, cand: (cand.fillna("UNKNOWN", subset=levels), ["user_id", *levels]))


def _prices(ts: str) -> list[Family]:
    own = _item("q_category_price", ts, lambda spark, cand, sizes: spark.table("o_price_log"), (), "update_date", carried=("selling_price",), log=_log("o_price_log", "item_id"))
    mean = Family("q_category_price", ("leaf",), ts, "update_date", lambda spark, cand: A.category_price(spark.table("o_price_log"), spark.table("o_item_meta"), "item_id", "update_date", "leaf"),
                  ("price_diff_from_category_avg", "avg_price_in_leaf_category"), ("avg_price_in_leaf_category",),
                  lambda d: d.withColumn("price_diff_from_category_avg", F.col("selling_price") - F.col("avg_price_in_leaf_category")))
    return [own, mean]


def _so_far(spark, cand, sizes):
    return A.action_so_far(spark.table("e_user_item_log"), ["user_id", "item_id"], "ts_hour", QA.ACTIONS, sizes).withColumnRenamed("item_id", "item10_id")


def _age(spark, cand):
    return A.age_affinity(QA._interactions(spark), QA._clean_users(spark), "user_id", "item_id", "ts_hour", "birth_year").withColumnRenamed("item_id", "item10_id")


def _gender(spark, cand):
    return A.gender_affinity(QA._interactions(spark), QA._clean_users(spark), "user_id", "item_id", "ts_hour", "gender", male="M", female="F").withColumnRenamed("item_id", "item10_id")


_AGE = ("avg_interaction_age_historical", "stddev_interaction_age_historical")
_RATES = ("female_conversion_rate_historical", "male_conversion_rate_historical")

#: All families of the first stack, on the hourly candidates.
STACK_A = [
    *[_counters(q, "ts_hour") for q in ("q_user_ctr_asof", "q_user_search_ctr", "q_user_term_ctr", "q_user_item_ratios", "q_term_ctr")],
    _counters("q_item_term_ctr", "date"),
    Family("q_user_item_search_semi", ("user_id", "item10_id"), "ts_hour", "ts_hour", lambda spark, cand, sizes: QC.search_clicks(spark, sizes), tuple(QC.SEARCH_CLICKS.values()), log=_log("e_user_item_log", "user_id", "item_id")),
    Family("q_so_far_recency", ("user_id", "item10_id"), "ts_hour", "ts_hour", _so_far, (*QA._SO_FAR, *QA._RECENCY), (*QA._SO_FAR, *QA._RECENCY.values()), lambda d: A.recency_hours(d, "ts_hour", QA._RECENCY), log=_log("e_user_item_log", "user_id", "item_id")),
    Family("q_age_affinity", ("item10_id",), "ts_hour", "ts_hour", _age, _AGE),
    Family("q_gender_affinity", ("item10_id",), "ts_hour", "ts_hour", _gender, (*QA._GENDER, *_RATES), tuple(QA._GENDER), A.gender_rates),
    *_by_item("date"), _affinity("ts_hour"), *_prices("date"),
]


def _cumulative(cols, groups, alias, weights):
    return lambda spark, cand, sizes: history_table(spark.table("o_item_log"), ["item_id"], "date", cols, groups, alias, weights, sizes=sizes)


SITE_HISTORY = history_columns(SITE, P.SITE_RATIO_GROUPS, "content_sitewide")
SEARCH_HISTORY = history_columns(SEARCH, P.SEARCH_RATIO_GROUPS, "content_search")
ROLLING = rolling_columns(SEARCH, ["3d", "7d"], P.ROLLING_AGGS, P.ROLLING_SEARCH_RATIOS, P.ROLLING_RATIO_AGGS, "content_search")

#: As-of families of the second stack, on the daily candidates.
STACK_B = [
    *_by_item("ts"), _affinity("ts"), *_prices("ts"),
    _item("", "ts", _cumulative(SITE, P.SITE_RATIO_GROUPS, "content_sitewide", P.SITE_WEIGHTS), SITE_HISTORY, fill=0, log=_ITEM_LOG),
    _item("", "ts", _cumulative(SEARCH, P.SEARCH_RATIO_GROUPS, "content_search", P.SEARCH_WEIGHTS), SEARCH_HISTORY, fill=0, log=_ITEM_LOG),
    _item("q_rolling_history_daily", "ts", lambda spark, cand, sizes: rolling_table(spark.table("o_item_log"), "item_id", "date", ["3d", "7d"], SEARCH, P.ROLLING_SEARCH_RATIOS, P.ROLLING_AGGS, P.ROLLING_RATIO_AGGS, "content_search", sizes),
          ROLLING, strict=False, log=_ITEM_LOG),
]


def attach(spark, candidates: DataFrame, families: Iterable[Family]) -> DataFrame:
    """``candidates`` (a stored table) with the features of all families: one as-of join per distinct (keys, time). Joins that
    bring few columns come first, so that the candidates are narrow when they move."""
    families, groups, out = list(families), {}, candidates
    for f in families:
        groups.setdefault((f.on, f.ts), []).append(f)
    for (on, ts), own in sorted(groups.items(), key=lambda g: sum(len(f.joined) for f in g[1])):
        # a relation without a log to count is stored and counted itself
        made = {i: stage(f.relation(spark, candidates), "relation") for i, f in enumerate(own) if f.log is None}
        read = [f.log(spark, candidates) for f in own if f.log]
        logs = {(df.semanticHash(), *keys): (df, keys) for df, keys in read}
        sizes = key_sizes((candidates, list(on)), *logs.values(), *[(rows, list(on)) for rows in made.values()])
        sizes = replace(sizes, shared=len(logs) < len(read))
        relations = [made[i] if i in made else f.relation(spark, candidates, sizes) for i, f in enumerate(own)]
        out = asof_once(out, list(on), ts, [Source(r, on, f.right_ts, f.joined, f.strict) for f, r in zip(own, relations)], sizes, probes_from=candidates)
    for f in families:
        if f.fill is not None:
            out = out.fillna(f.fill, subset=list(f.features))
        if f.finish:
            out = f.finish(out)
    return out
