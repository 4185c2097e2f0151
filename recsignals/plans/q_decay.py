"""Session-step decay histories (C7, C8; W31, W32; J8-J11; A1-A3, A8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from recsignals.operators.decay import decay_columns, session_decay_history, session_steps
from recsignals.plans import params as P
from recsignals.plans.registry import query

SITE = ["total_click", "total_order", "total_cart", "total_fav"]
SEARCH = ["total_search_click", "total_search_impression"]

_STEPS_SQL = """
, st AS (SELECT user_id, ts_hour, row_number() OVER (PARTITION BY user_id ORDER BY ts_hour) AS interaction_step
         FROM (SELECT user_id, ts_hour FROM {log} UNION SELECT user_id, ts_hour FROM e_base))"""


@query("q_session_steps", fixtures=("e_base", "e_user_item_log"), oracle=_STEPS_SQL.format(log="e_user_item_log") + """
SELECT user_id, CAST(EXTRACT(EPOCH FROM ts_hour) AS BIGINT) AS ts_epoch, CAST(interaction_step AS BIGINT) AS interaction_step
FROM st""")
def q_session_steps(spark, sf_dir):
    """Dense per-user step index of distinct times over candidates and log."""
    st = session_steps(spark.table("e_base"), spark.table("e_user_item_log"), "user_id", "ts_hour")
    return st.select("user_id", F.unix_seconds(F.col("ts_hour").cast("timestamp")).alias("ts_epoch"),
                     "interaction_step")


def _decay_sql(log, cols, keys_join, cand_cols, alias, windows, last_raw):
    it_cols = ", ".join(cols)
    sel = []
    for c in cols:
        sel.append(f"SUM({c} * w) AS {c}_decay_score_{alias}")
        for n in windows:
            sel += [f"AVG(CASE WHEN back <= {n} THEN {c} * w END) AS {c}_weighted_{n}roll_step_mean_{alias}",
                    f"STDDEV_SAMP(CASE WHEN back <= {n} THEN {c} * w END) AS {c}_weighted_{n}roll_step_std_{alias}",
                    f"AVG(CASE WHEN back <= {n} THEN {c} END) AS {c}_{n}roll_step_mean_{alias}",
                    f"SUM(CASE WHEN back <= {n} THEN {c} END) AS {c}_{n}roll_step_sum_{alias}"]
        if last_raw:
            sel.append(f"MAX(CASE WHEN back = 1 THEN {c} END) AS {c}_{alias}")
    part = ", ".join(f"cd.{k}" for k in cand_cols)
    new = decay_columns(cols, windows, alias, last_raw)
    raw = {f"{c}_{alias}" for c in cols} if last_raw else set()
    out = ", ".join(f"ROUND(CAST({'a.' + x if x in raw else 'COALESCE(a.' + x + ', 0)'} AS DOUBLE), 6) AS {x}"
                    for x in new)
    on = " AND ".join(f"b.{bk} = a.{ak}" for bk, ak in keys_join)
    return _STEPS_SQL.format(log=log) + f"""
, it AS (SELECT l.*, st.interaction_step AS step_r FROM {log} l JOIN st USING (user_id, ts_hour))
, cd AS (SELECT DISTINCT {', '.join('b.' + bk + ' AS ' + ck for (bk, _), ck in zip(keys_join, cand_cols))}, b.ts_hour, st.interaction_step AS step
         FROM e_base b JOIN st USING (user_id, ts_hour))
, pr AS (SELECT {part}, cd.ts_hour, {', '.join('it.' + c for c in cols)},
    exp((cd.step - it.step_r) * ln(0.5) / {P.DECAY_HALF_LIFE_STEPS}) AS w,
    row_number() OVER (PARTITION BY {part}, cd.step ORDER BY it.step_r DESC) AS back
  FROM cd JOIN it ON {' AND '.join(f'cd.{k} = it.{k}' for k in cand_cols)} AND cd.step > it.step_r)
, a AS (SELECT {', '.join(cand_cols)}, ts_hour, {', '.join(sel)} FROM pr GROUP BY {', '.join(cand_cols)}, ts_hour)
SELECT b.row_id, {out}
FROM e_base b LEFT JOIN a ON {on} AND b.ts_hour = a.ts_hour"""


_C7 = decay_columns(SITE, P.DECAY_WINDOWS, "fashion_site")


@query("q_decay_pair", fixtures=("e_base", "e_user_item_log"),
       oracle=_decay_sql("e_user_item_log", SITE, [("user_id", "user_id"), ("item10_id", "item_id")],
                         ["user_id", "item_id"], "fashion_site", P.DECAY_WINDOWS, True))
def q_decay_pair(spark, sf_dir):
    """(user, item) decay scores and last-N step statistics."""
    base = spark.table("e_base").select("row_id", "user_id", F.col("item10_id").alias("item_id"), "ts_hour")
    out = session_decay_history(base, spark.table("e_user_item_log"), SITE, ["user_id", "item_id"], "user_id",
                                "ts_hour", P.DECAY_WINDOWS, P.DECAY_HALF_LIFE_STEPS, alias="fashion_site")
    return out.select("row_id", *[F.col(c).cast("double").alias(c) for c in _C7])


_C8 = decay_columns(SEARCH, P.DECAY_WINDOWS, "user_search", last_raw=False)


@query("q_decay_single", fixtures=("e_base", "e_user_search_log"),
       oracle=_decay_sql("e_user_search_log", SEARCH, [("user_id", "user_id")], ["user_id"], "user_search",
                         P.DECAY_WINDOWS, False))
def q_decay_single(spark, sf_dir):
    """User-level decay scores and last-N step statistics."""
    base = spark.table("e_base").select("row_id", "user_id", "ts_hour")
    out = session_decay_history(base, spark.table("e_user_search_log"), SEARCH, ["user_id"], "user_id",
                                "ts_hour", P.DECAY_WINDOWS, P.DECAY_HALF_LIFE_STEPS, alias="user_search",
                                last_raw=False)
    return out.select("row_id", *[F.col(c).cast("double").alias(c) for c in _C8])
