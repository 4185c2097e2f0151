"""Session, target, sampling, blending and evaluation queries
(C9, C27, C29-C31, C36-C39; W19-W23; O4, O8; A7, A11; J16; F2-F5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from recsignals.functions.expr import micros
from recsignals.operators import session as S
from recsignals.operators.asof import asof_join
from recsignals.operators.hot import key_sizes
from recsignals.plans import params as P
from recsignals.operators.profile import clean_birth_year
from recsignals.plans.q_affinity import _CLEAN_SQL as CLEAN_SQL
from recsignals.plans.registry import query
from recsignals.session import stage
from recsignals.plans.sqlfmt import rnd


@query("q_candidate_count", fixtures=("o_base",), oracle="""
SELECT b.row_id, CAST(c.n AS BIGINT) AS session_candidate_count
FROM o_base b JOIN (SELECT session_id, count(item_id) AS n FROM o_base GROUP BY session_id) c USING (session_id)""")
def q_candidate_count(spark, sf_dir):
    """Candidates per session on every row."""
    return S.candidate_count(spark.table("o_base"), "session_id", "item_id").select("row_id", "session_candidate_count")


_MEAS = {"price": "selling_price", "review_count": "review_count", "review_wth_media_count": "review_media_count",
         "rate": "rate_avg", "rate_count": "rate_count"}
_STAT_COLS = (["session_item_count", "is_cheapest_in_session", "is_most_expensive_in_session"]
              + [f"session_{a}_{m}" for m in _MEAS for a in ("avg", "std", "min", "max")]
              + [f"{m}_rank" for m in _MEAS] + [f"{m}_diff_percent" for m in _MEAS])


def _stats_sql():
    w = "OVER (PARTITION BY session_id)"
    parts = ["CAST(COUNT(item_id) OVER (PARTITION BY session_id) AS BIGINT) AS session_item_count",
             f"CAST(CASE WHEN selling_price = MIN(selling_price) {w} THEN 1 ELSE 0 END AS BIGINT) AS is_cheapest_in_session",
             f"CAST(CASE WHEN selling_price = MAX(selling_price) {w} THEN 1 ELSE 0 END AS BIGINT) AS is_most_expensive_in_session"]
    for m, c in _MEAS.items():
        parts += [f"ROUND(CAST(AVG({c}) {w} AS DOUBLE), 5) AS session_avg_{m}",
                  f"ROUND(CAST(STDDEV_SAMP({c}) {w} AS DOUBLE), 3) AS session_std_{m}",
                  f"ROUND(CAST(MIN({c}) {w} AS DOUBLE), 6) AS session_min_{m}",
                  f"ROUND(CAST(MAX({c}) {w} AS DOUBLE), 6) AS session_max_{m}",
                  f"CAST(RANK() OVER (PARTITION BY session_id ORDER BY {c} ASC NULLS LAST) AS BIGINT) AS {m}_rank",
                  f"ROUND(100.0 * ({c} - AVG({c}) {w}) / NULLIF(AVG({c}) {w}, 0), 6) AS {m}_diff_percent"]
    return ", ".join(parts)


@query("q_session_stats", fixtures=("o_base", "o_price_log"), oracle=f"""
, j AS (SELECT b.row_id, b.session_id, b.item_id, p.selling_price, p.review_count, p.review_media_count, p.rate_avg, p.rate_count
        FROM o_base b ASOF LEFT JOIN o_price_log p ON b.item_id = p.item_id AND b.ts > p.update_date)
SELECT row_id, {_stats_sql()} FROM j""")
def q_session_stats(spark, sf_dir):
    """In-session size, price flags, stats, ranks and % differences."""
    base = spark.table("o_base").select("row_id", "session_id", "item_id", "ts")
    j = asof_join(base, spark.table("o_price_log"), ["item_id"], "ts", right_ts="update_date",
                  right_cols=list(dict.fromkeys(_MEAS.values())))
    d = S.session_stats(stage(j, "session-prices"), "session_id", "item_id", _MEAS, "selling_price", "row_id")
    # session std of prices in the thousands: compared at 3 decimals, where
    # the two engines' variance-algorithm noise cannot reach
    # (means at 5 decimals: means of few 2-4 decimal prices sit on 6-decimal ties)
    coarse = {f"session_std_{m}": 1e3 for m in _MEAS} | {f"session_avg_{m}": 1e5 for m in _MEAS}
    return d.select("row_id", *[(F.round(F.col(c) * coarse[c], 0) / coarse[c]).alias(c) if c in coarse
                                else F.col(c) for c in _STAT_COLS])


@query("q_static_features", fixtures=("o_base", "o_item_meta", "o_user_meta"), oracle=CLEAN_SQL + """
SELECT b.row_id, CAST(YEAR(b.ts) - u.birth_year AS DOUBLE) AS candidate_age, CAST(length(replace(m.level1, ' ', '_')) AS DOUBLE) AS search_term_length,
  CAST(length(split(replace(m.level1, ' ', '_'), '_')) AS DOUBLE) AS search_term_word_count,
  CAST(length(split(m.tags, ',')) AS DOUBLE) AS cv_tags_word_count,
  ROUND(EXTRACT(EPOCH FROM b.ts - m.created_ts) / 86400.0, 6) AS content_tenure_days
FROM o_base b LEFT JOIN o_item_meta m ON b.item_id = m.item_id LEFT JOIN um u ON b.user_id = u.user_id""")
def q_static_features(spark, sf_dir):
    """User age at the candidate, search-term length / word count, tag count, content tenure days (C29; F2-F5)."""
    users = clean_birth_year(spark.table("o_user_meta"), "birth_year").select("user_id", "birth_year")
    d = spark.table("o_base").join(spark.table("o_item_meta"), "item_id", "left").join(users, "user_id", "left")
    term = F.regexp_replace("level1", " ", "_")
    return d.select("row_id", (F.year("ts") - F.col("birth_year")).cast("double").alias("candidate_age"), F.length(term).cast("double").alias("search_term_length"),
                    F.when(term.isNotNull(), F.size(F.split(term, "_"))).cast("double").alias("search_term_word_count"),
                    F.when(F.col("tags").isNotNull(), F.size(F.split("tags", ","))).cast("double")
                    .alias("cv_tags_word_count"),
                    ((micros("ts") - micros("created_ts")) / 8.64e10).alias("content_tenure_days"))


def _target_sql(w):
    return " + ".join(f"{c} * {v}" for c, v in w.items())


@query("q_weighted_target", fixtures=("o_base",), oracle=f"""
SELECT row_id, ROUND({_target_sql(P.TARGET_WEIGHTS_A)}, 6) AS target_a, ROUND({_target_sql(P.TARGET_WEIGHTS_B)}, 6) AS target_b
FROM o_base""")
def q_weighted_target(spark, sf_dir):
    """Weighted ranking targets of both stacks."""
    d = S.weighted_target(spark.table("o_base"), P.TARGET_WEIGHTS_A, "target_a")
    d = S.weighted_target(d, P.TARGET_WEIGHTS_B, "target_b")
    return d.select("row_id", "target_a", "target_b")


_LABELS = ["ordered", "clicked", "added_to_cart", "added_to_fav"]


@query("q_downsample_limit2", fixtures=("o_base",), oracle=f"""
, t AS (SELECT *, {' + '.join(_LABELS)} AS new_target FROM o_base)
, r AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY item_id) AS rn FROM t WHERE new_target = 0)
SELECT row_id FROM t WHERE new_target > 0
UNION ALL SELECT row_id FROM r WHERE rn <= 2""")
def q_downsample_limit2(spark, sf_dir):
    """Negative downsampling with a cap of 2 negatives per session, in item order."""
    return S.downsample_negatives(spark.table("o_base"), "session_id", _LABELS, 2, order="item_id").select("row_id")


@query("q_downsample", fixtures=("o_base",), oracle=f"""
, t AS (SELECT *, {' + '.join(_LABELS)} AS new_target FROM o_base)
, r AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY item_id) AS rn FROM t WHERE new_target = 0)
SELECT row_id FROM t WHERE new_target > 0
UNION ALL SELECT row_id FROM r WHERE rn <= {P.NEGATIVE_LIMIT}""")
def q_downsample(spark, sf_dir):
    """Negative downsampling with the stack's cap of 1000 negatives per session."""
    return S.downsample_negatives(spark.table("o_base"), "session_id", _LABELS, P.NEGATIVE_LIMIT,
                                  order="item_id").select("row_id")


@query("q_time_split", fixtures=("o_base",), oracle="""
SELECT row_id, CAST(CASE WHEN ts = (SELECT max(ts) FROM o_base) THEN 1 ELSE 0 END AS BIGINT) AS is_validation FROM o_base""")
def q_time_split(spark, sf_dir):
    """Validation = rows at the last time of the data."""
    tr, va = S.time_split(spark.table("o_base"), "ts")
    return (tr.select("row_id", F.lit(0).alias("is_validation"))
            .unionByName(va.select("row_id", F.lit(1).alias("is_validation"))))


@query("q_blend", fixtures=("o_base",), oracle=f"""
SELECT session_id, user_id, item_id,
  ROUND(({_target_sql(P.TARGET_WEIGHTS_B)}) * 0.5 + ({_target_sql(P.TARGET_WEIGHTS_A)}) * 0.5, 6) AS prediction
FROM o_base""")
def q_blend(spark, sf_dir):
    """Inner join of two score sets on (session, user, item) and 0.5/0.5 blend."""
    base = spark.table("o_base")
    keys = ["session_id", "user_id", "item_id"]
    a = S.weighted_target(base, P.TARGET_WEIGHTS_B, "prediction").select(*keys, "prediction")
    b = S.weighted_target(base, P.TARGET_WEIGHTS_A, "other_prediction").select(*keys, "other_prediction")
    return S.blend_scores(a, b, keys, "prediction", "other_prediction", P.BLEND_WEIGHTS).select(*keys, "prediction")


@query("q_ranked_list", fixtures=("o_base",), oracle=f"""
SELECT session_id, string_agg(CAST(item_id AS VARCHAR), ' ' ORDER BY ({_target_sql(P.TARGET_WEIGHTS_A)}) DESC,
  CAST(item_id AS VARCHAR)) AS prediction
FROM o_base GROUP BY session_id""")
def q_ranked_list(spark, sf_dir):
    """Per session: items by descending score joined with spaces."""
    d = S.weighted_target(spark.table("o_base"), P.TARGET_WEIGHTS_A, "score")
    return S.ranked_list(d, "session_id", "item_id", "score")


@query("q_session_rank", fixtures=("o_base",), oracle=f"""
SELECT row_id, CAST(RANK() OVER (PARTITION BY session_id ORDER BY ({_target_sql(P.TARGET_WEIGHTS_A)}) DESC, item_id) AS BIGINT) AS rank
FROM o_base""")
def q_session_rank(spark, sf_dir):
    """Candidate position in its session by descending score."""
    d = S.weighted_target(spark.table("o_base"), P.TARGET_WEIGHTS_A, "score")
    return S.session_rank(d, "session_id", "item_id", "score").select("row_id", "rank")


@query("q_auc_ranksum", fixtures=("o_base",), oracle=f"""
, s AS (SELECT ({_target_sql(P.TARGET_WEIGHTS_B)}) AS score, ordered AS label FROM o_base)
, r AS (SELECT score, label, RANK() OVER (ORDER BY score) AS lo, count(*) OVER (PARTITION BY score) AS n FROM s)
, a AS (SELECT SUM(CASE WHEN label > 0 THEN lo + (n - 1) / 2.0 ELSE 0 END) AS rs,
               SUM(CASE WHEN label > 0 THEN 1 ELSE 0 END) AS np, SUM(CASE WHEN label > 0 THEN 0 ELSE 1 END) AS nn FROM r)
SELECT ROUND((rs - np * (np + 1) / 2.0) / (np * nn), 6) AS auc, CAST(np AS BIGINT) AS n_pos, CAST(nn AS BIGINT) AS n_neg FROM a""")
def q_auc_ranksum(spark, sf_dir):
    """Rank-sum ROC AUC of the stack-B target against the order label."""
    d = S.weighted_target(spark.table("o_base"), P.TARGET_WEIGHTS_B, "score")
    return S.auc_ranksum(d, "score", "ordered")


_PRICE_FEATS = ["original_price", "selling_price", "discounted_price", "rate_count", "review_count", "review_media_count", "rate_avg"]


def _corr_prune_sql(threshold: float) -> str:
    """Pairs in falling order of correlation, taken one after the other by a recursive query."""
    cells = [f"{{'a': '{a}', 'b': '{b}', 'r': abs(corr({a}, {b}))}}" for i, a in enumerate(_PRICE_FEATS) for b in _PRICE_FEATS[i + 1:]]
    aims = [f"{{'f': '{a}', 'r': coalesce(abs(corr({a}, target)), 0)}}" for a in _PRICE_FEATS]
    target = " + ".join(f"{c} * {w}" for c, w in P.TARGET_WEIGHTS_A.items())
    return f"""
, j AS (SELECT CAST({target} AS DOUBLE) AS target, {', '.join(f'p.{c}' for c in _PRICE_FEATS)}
        FROM o_base b ASOF LEFT JOIN o_price_log p ON b.item_id = p.item_id AND b.ts > p.update_date)
, aim AS (SELECT x.f, x.r FROM (SELECT unnest([{', '.join(aims)}]) AS x FROM j))
, pairs AS (SELECT x.a AS a, x.b AS b, row_number() OVER (ORDER BY x.r DESC) AS n FROM (SELECT unnest([{', '.join(cells)}]) AS x FROM j) WHERE x.r > {threshold})
, told AS (SELECT n, CASE WHEN ta.r < tb.r THEN a ELSE b END AS loser, CASE WHEN ta.r < tb.r THEN b ELSE a END AS winner
           FROM pairs JOIN aim ta ON ta.f = a JOIN aim tb ON tb.f = b)
, walk AS (SELECT * FROM (WITH RECURSIVE w(n, gone, cause) AS (
      SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[])
      UNION ALL SELECT t.n, CASE WHEN list_contains(gone, loser) OR list_contains(gone, winner) THEN gone ELSE list_append(gone, loser) END,
        CASE WHEN list_contains(gone, loser) OR list_contains(gone, winner) THEN cause ELSE list_append(cause, winner) END
      FROM w JOIN told t ON t.n = w.n + 1) SELECT * FROM w ORDER BY n DESC LIMIT 1))
SELECT f AS feature, ROUND(r, 6) AS target_corr, CAST(NOT list_contains(gone, f) AS BIGINT) AS kept, cause[list_position(gone, f)] AS dropped_for FROM aim, walk"""


@query("q_corr_prune", fixtures=("o_base", "o_price_log"), oracle=_corr_prune_sql(0.98))
def q_corr_prune(spark, sf_dir):
    """Correlation pruning of candidate price features against the stack-A
    target, threshold 0.98; rows with a missing value count where they have both (C32)."""
    from recsignals.operators.selection import prune_correlated

    base = S.weighted_target(spark.table("o_base"), P.TARGET_WEIGHTS_A, "target").select("row_id", "item_id", "ts", "target")
    prices = spark.table("o_price_log")
    j = asof_join(base, prices, ["item_id"], "ts", right_ts="update_date", right_cols=_PRICE_FEATS, sizes=key_sizes((base, ["item_id"]), (prices, ["item_id"])))
    return prune_correlated(j, _PRICE_FEATS, "target", 0.98)


_RANK_FEATS = ["original_price", "selling_price", "discounted_price", "rate_count", "review_count",
               "review_media_count", "rate_avg"]


def _ranker_data(spark):
    base = S.weighted_target(spark.table("o_base"), P.TARGET_WEIGHTS_A, "target")
    prices = spark.table("o_price_log")
    return asof_join(base.select("row_id", "session_id", "item_id", "ts", "target"), prices, ["item_id"], "ts", right_ts="update_date",
                     right_cols=_RANK_FEATS, sizes=key_sizes((base, ["item_id"]), (prices, ["item_id"])))


@query("q_ranker_scores", fixtures=("o_base", "o_price_log"))
def q_ranker_scores(spark, sf_dir):
    """Train on rows before the last date, score every candidate (C34, C35; rows-only)."""
    from recsignals.operators.ranker import score, train_session_ranker
    data = stage(_ranker_data(spark), "ranker-data")
    train, _ = S.time_split(data, "ts")
    model = train_session_ranker(train, _RANK_FEATS, "target")
    return score(model, data, _RANK_FEATS, ["row_id", "session_id"])


@query("q_importance_cut", fixtures=("o_base", "o_price_log"))
def q_importance_cut(spark, sf_dir):
    """Features covering 99 % of the trained model's importance (C33; rows-only)."""
    from recsignals.operators.ranker import importance_cut, train_session_ranker

    train, _ = S.time_split(stage(_ranker_data(spark), "ranker-data"), "ts")
    model = train_session_ranker(train, _RANK_FEATS, "target")
    return importance_cut(spark, model, _RANK_FEATS, 0.99)


_SITE = ["total_click", "total_cart", "total_order", "total_fav"]
_SEARCH = ["total_search_impression", "total_search_click"]
_SR_OUT = ["avg_content_search_and_sitewide_rank", "median_content_search_and_sitewide_rank",
           "total_content_search_and_sitewide_weighted_score", "rank_session_id_content_sitewide_weighted_score",
           "rank_session_id_content_search_weighted_score"]


_SR_TABLES = {"content_sitewide": _SITE, "content_search": _SEARCH}
_SR_RATIOS = {"content_sitewide": [f"{a}_to_{b}_avg_ratio" for a, b in P.SITE_RATIO_GROUPS],
              "content_search": [f"{a}_to_{b}_avg_ratio" for a, b in P.SEARCH_RATIO_GROUPS]}


def _session_ranks_sql():
    from recsignals.plans.q_history import _hist_sql

    site = _hist_sql("o_item_log", ["item_id"], "date", _SITE, P.SITE_RATIO_GROUPS, "content_sitewide",
                     P.SITE_WEIGHTS, name="hs")
    srch = _hist_sql("o_item_log", ["item_id"], "date", _SEARCH, P.SEARCH_RATIO_GROUPS, "content_search",
                     P.SEARCH_WEIGHTS, name="hq")
    # six, two and one votes: fixed by the feature's definition
    existing = [f"content_sitewide_{c}" for c in _SITE] * 6 + [f"content_search_{c}" for c in _SEARCH] * 2
    groups = {t: [f"{t}_{r}" for r in _SR_RATIOS[t]] for t in _SR_TABLES}
    existing += groups["content_sitewide"] + groups["content_search"]
    # float64 weights, as in the original (a DECIMAL literal would make DuckDB tie scores that
    # are equal only in exact arithmetic)
    ws = {"content_sitewide": " + ".join(f"CAST(COALESCE(content_sitewide_{c}, 0) AS DOUBLE) * CAST({P.SESSION_COL_WEIGHTS[c]} AS DOUBLE)" for c in _SITE),
          "content_search": " + ".join(f"CAST(COALESCE(content_search_{c}, 0) AS DOUBLE) * CAST({P.SESSION_COL_WEIGHTS[c]} AS DOUBLE)" for c in _SEARCH)}

    def rk(c):
        return f"CASE WHEN {c} IS NULL THEN NULL ELSE RANK() OVER (PARTITION BY session_id ORDER BY {c} DESC NULLS LAST) END"

    ranks = [rk("content_sitewide_ws"), rk("content_search_ws")] + [rk(c) for c in existing]
    fill_s = ", ".join(f"COALESCE(s.{c}, 0) AS {c}" for c in [f"content_sitewide_{c}" for c in _SITE] + groups["content_sitewide"])
    fill_q = ", ".join(f"COALESCE(q.{c}, 0) AS {c}" for c in [f"content_search_{c}" for c in _SEARCH] + groups["content_search"])
    return site + srch + f"""
, j AS (SELECT b.row_id, b.session_id, {fill_s}, {fill_q}
        FROM o_base b ASOF LEFT JOIN hs s ON b.item_id = s.item_id AND b.ts > s.date
                      ASOF LEFT JOIN hq q ON b.item_id = q.item_id AND b.ts > q.date)
, w AS (SELECT *, {ws['content_sitewide']} AS content_sitewide_ws, {ws['content_search']} AS content_search_ws FROM j)
, r AS (SELECT row_id, content_sitewide_ws, content_search_ws, [{', '.join(ranks)}] AS rl,
        {rk('content_sitewide_ws')} AS rank_session_id_content_sitewide_weighted_score,
        {rk('content_search_ws')} AS rank_session_id_content_search_weighted_score FROM w)
SELECT row_id, ROUND(list_avg(rl), 6) AS avg_content_search_and_sitewide_rank,
  ROUND(CAST(list_median(rl) AS DOUBLE), 6) AS median_content_search_and_sitewide_rank,
  ROUND(content_sitewide_ws * {P.SESSION_TABLE_WEIGHTS['content_sitewide']} + content_search_ws * {P.SESSION_TABLE_WEIGHTS['content_search']}, 6) AS total_content_search_and_sitewide_weighted_score,
  CAST(rank_session_id_content_sitewide_weighted_score AS DOUBLE) AS rank_session_id_content_sitewide_weighted_score,
  CAST(rank_session_id_content_search_weighted_score AS DOUBLE) AS rank_session_id_content_search_weighted_score
FROM r"""


@query("q_session_ranks", fixtures=("o_base", "o_item_log"), oracle=_session_ranks_sql())
def q_session_ranks(spark, sf_dir):
    """In-session ranks of item site-wide and search histories, with mean /
    median rank (multiplicity kept) and table-weighted score (C10)."""
    from recsignals.operators.history import cumulative_history

    base = spark.table("o_base").select("row_id", "session_id", "item_id", F.col("ts").alias("date"))
    log = spark.table("o_item_log")
    votes = S.rank_votes(_SR_TABLES, _SR_RATIOS)
    scores = {t: {f"{t}_{c}": P.SESSION_COL_WEIGHTS[c] for c in cols} for t, cols in _SR_TABLES.items()}
    sizes = key_sizes((base, ["item_id"]), (log, ["item_id"]))
    used = list(dict.fromkeys([*votes, *[c for own in scores.values() for c in own]]))
    d = cumulative_history(base, log, ["item_id"], "date", _SITE, P.SITE_RATIO_GROUPS, "content_sitewide",
                           P.SITE_WEIGHTS, attach=used, sizes=sizes)
    d = cumulative_history(d, log, ["item_id"], "date", _SEARCH, P.SEARCH_RATIO_GROUPS, "content_search",
                           P.SEARCH_WEIGHTS, probes_from=base, attach=used, sizes=sizes)
    d = stage(d.select("row_id", "session_id", *used), "session-ranks-in")
    out = S.session_ranks(d, "session_id", "row_id", votes, scores, P.SESSION_TABLE_WEIGHTS)
    return out.select("row_id", *[F.col(c).cast("double").alias(c) for c in _SR_OUT])
