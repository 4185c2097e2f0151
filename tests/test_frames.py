"""Property tests for the bucketed primitives on tiny hand-made frames:
the hot-key (time-split) path must equal the plain path and brute force."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recsignals.operators.asof import asof_join
from recsignals.operators.frames import range_agg, row_index, running_agg
from recsignals.operators.history import history_table


def ts(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


@pytest.fixture(scope="module")
def log(spark):
    # key 1 is "hot": many rows over several weeks; key 2 sparse; key None
    rows = [(1, ts(h), h % 5) for h in range(0, 24 * 40, 7)] + [(2, ts(5), 3), (2, ts(500), 4), (None, ts(9), 1)]
    return spark.createDataFrame(rows, "k long, t timestamp_ntz, v long")


@pytest.mark.parametrize("width", [None, 86400 * 10**6])
def test_range_agg_matches_bruteforce(spark, log, width):
    out = range_agg(log, ["k"], "t", [("s", "sum", "v", "72h"), ("c", "count", "v", "72h")],
                    {"72h": (-72 * 3600 * 10**6, -1)}, bucket_us=width)
    got = {(r.k, r.t): (r.s, r.c) for r in out.collect()}
    data = log.collect()
    for r in data:
        inside = [x.v for x in data if x.k == r.k and x.k is not None
                  and r.t - dt.timedelta(hours=72) <= x.t < r.t]
        if r.k is None:
            continue
        assert got[(r.k, r.t)] == ((sum(inside) if inside else None), len(inside))


@pytest.mark.parametrize("width", [None, 86400 * 10**6])
@pytest.mark.parametrize("incl", [True, False])
def test_running_agg_matches_bruteforce(spark, log, width, incl):
    out = running_agg(log, ["k"], "t", [("s", "sum", "v"), ("m", "max", "v"), ("sd", "std", "v")],
                      include_current=incl, bucket_us=width)
    got = {(r.k, r.t): (r.s, r.m, r.sd) for r in out.collect() if r.k is not None}
    data = [r for r in log.collect() if r.k is not None]
    for r in data:
        inside = [x.v for x in data if x.k == r.k and (x.t <= r.t if incl else x.t < r.t)]
        s, m, sd = got[(r.k, r.t)]
        assert s == (sum(inside) if inside else None)
        assert m == (max(inside) if inside else None)
        if len(inside) > 1:
            mu = sum(inside) / len(inside)
            ref = (sum((x - mu) ** 2 for x in inside) / (len(inside) - 1)) ** 0.5
            assert abs(sd - ref) < 1e-9
        else:
            assert sd is None


def test_row_index_hot_equals_plain(spark, log):
    a = {(r.k, r.t): r.i for r in row_index(log, ["k"], "t", alias="i", bucket_us=86400 * 10**6).collect()}
    b = {(r.k, r.t): r.i for r in row_index(log, ["k"], "t", alias="i").collect()}
    assert a == b and max(a.values()) == 138


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("width", [None, 86400 * 10**6])
def test_asof_strict_and_inclusive(spark, log, strict, width):
    left = spark.createDataFrame([(1, ts(7)), (1, ts(8)), (1, ts(900)), (2, ts(5)), (2, ts(499)), (None, ts(9)),
                                  (3, ts(1))], "k long, t timestamp_ntz")
    out = asof_join(left, log, ["k"], "t", strict=strict, right_cols=["v"], bucket_us=width)
    got = sorted((r.k if r.k is not None else -1, r.t, r.v) for r in out.collect())
    data = log.collect()

    def expect(k, t):
        if k is None:
            return None
        cands = [x for x in data if x.k == k and (x.t < t if strict else x.t <= t)]
        return max(cands, key=lambda x: x.t).v if cands else None

    want = sorted((r.k if r.k is not None else -1, r.t, expect(r.k, r.t)) for r in left.collect())
    assert got == want


def test_trailing_std_long_keys_use_row_window(spark):
    rows = [(1, ts(h), (h * 7) % 11) for h in range(30)]
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz, v long")
    out = history_table(df, ["k"], "t", ["v"], [], "a", {"v": 1.0}, std_rows=5)
    got = {r.t: r.a_v_std for r in out.collect()}
    vals = [v for _, _, v in rows]
    for i, (_, t, _) in enumerate(rows):
        win = vals[max(0, i - 4): i + 1]
        if len(win) < 2:
            assert got[t] is None
        else:
            mu = sum(win) / len(win)
            ref = (sum((x - mu) ** 2 for x in win) / (len(win) - 1)) ** 0.5
            assert abs(got[t] - ref) < 1e-9


def test_std_of_large_counters(spark):
    rows = [(1, ts(h), 10**9 + h % 3) for h in range(40)] + [(None, ts(h), 10**9 + h % 3) for h in range(9)]
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz, v long").withColumn("x", F.col("v") + 0.25)
    out = running_agg(df, ["k"], "t", [("sd", "std", "v"), ("sx", "std", "x")], bucket_us=5 * 3600 * 10**6)
    for r in out.collect():
        vals = [v for k, t, v in rows if k == r.k and t <= r.t]
        mu = sum(v - 10**9 for v in vals) / len(vals)
        want = (sum((v - 10**9 - mu) ** 2 for v in vals) / (len(vals) - 1)) ** 0.5 if len(vals) > 1 else None
        assert (r.sd is None and r.sx is None) if want is None else abs(r.sd - want) < 1e-9 and abs(r.sx - want) < 1e-6


def test_ranks_match_bruteforce(spark):
    from recsignals.operators.groups import rank_many, rank_within
    from recsignals.operators.session import auc_ranksum, session_rank

    values = [None, -3.5, 0.0, 1e-7, 2.0, 2.0, 2.0001, 1e12, 5.0, 5.0, None, float("nan")]
    rows = [(i, g, v) for g in ("a", None) for i, v in enumerate(values * 2, 100 if g else 0)]
    df = spark.createDataFrame(rows, "id long, g string, v double")
    key = lambda v: (v is None, v != v, v if v == v else 0)

    def rank(v, g, sign):
        own = [x for _, h, x in rows if h == g]
        k = lambda x: (True, False, 0) if x is None else (False, x != x, sign * x if x == x else 0)
        return 1 + sum(k(x) < k(v) for x in own)

    got = rank_within(rank_many(df, "id", [("up", "g", "v", True), ("down", "g", "v", False)]), ["g"], "v", "last").collect()
    for r in got:
        assert r.last == rank(r.v, r.g, 1)
        assert r.up == (None if r.v is None else rank(r.v, r.g, 1)) and r.down == (None if r.v is None else rank(r.v, r.g, -1))
    scored = df.where("v is not null and not isnan(v)")
    pos = {r.id: r.rank for r in session_rank(scored, "g", "id", "v").collect()}
    for g in ("a", None):
        own = sorted(((-v, i) for i, h, v in rows if h == g and v is not None and v == v))
        assert [pos[i] for _, i in own] == list(range(1, len(own) + 1))
    one = auc_ranksum(scored.withColumn("y", F.lit(1)), "v", "y").first()
    assert one.auc is None
    two = scored.withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    data = [(r.v, r.y) for r in two.collect()]
    p, n = [v for v, y in data if y], [v for v, y in data if not y]
    assert abs(auc_ranksum(two, "v", "y").first().auc - sum((a > b) + 0.5 * (a == b) for a in p for b in n) / len(p) / len(n)) < 1e-12


def test_decay_keeps_interactions_of_one_time(spark):
    from recsignals.operators.decay import session_decay_history

    logs = spark.createDataFrame([(1, 7, ts(1), 4.0), (1, 7, ts(1), 9.0), (1, 7, ts(0), 1.0)], "u long, i long, t timestamp_ntz, c double")
    train = spark.createDataFrame([(1, 7, ts(2))], "u long, i long, t timestamp_ntz")
    for keys in (["u", "i"], ["u"]):
        r = session_decay_history(train, logs, ["c"], keys, "u", "t", alias="x").first()
        assert (r.c_3roll_step_sum_x, round(r.c_3roll_step_mean_x, 6), r.c_x) == (14.0, round(14 / 3, 6), 9.0)
    with pytest.raises(ValueError):
        session_decay_history(train, logs, ["c"], ["u"], "u", "t", decay_value=0.1)


def test_ranks_of_small_and_large_groups(spark):
    """Ranks are the same by windows, by bands and mixed; cells go through one exchange, not one per rank."""
    from recsignals.operators import groups as G
    from recsignals.operators.session import session_stats

    rows = [(i, ["a", "b", "c", None][min(i % 7, 3)], i % 2, [None, float("nan"), -0.0, 0.0, 1.5, -2.0][i % 6] if i % 5 else float(i % 11), float(i * 37 % 101)) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, g string, h int, v double, w double")
    specs = [(f"{g}_{c}_{up}", g, c, up) for g in ("g", "h") for c in ("v", "w") for up in (True, False)]
    key = lambda x, up: (x != x, 0 if x != x else x if up else -x)
    want = {}
    for i, g, h, v, w in rows:
        val = {"v": v, "w": w}
        for a, p, c, up in specs:
            own = [{"v": r[3], "w": r[4]}[c] for r in rows if r[1 if p == "g" else 2] == (g if p == "g" else h)]
            want[i, a] = None if val[c] is None else 1 + sum(x is not None and key(x, up) < key(val[c], up) for x in own)
    for small, wanted in ((10**6, specs), (40, specs), (40, specs[:4]), (0, specs)):
        for n in (G.BAND_ROWS, 20):
            G.BAND_ROWS, kept = n, G.BAND_ROWS
            got = G.rank_many(df, "id", wanted, small).collect()
            G.BAND_ROWS = kept
            assert len(got) == len(rows) and all(r[a] == want[r.id, a] for r in got for a, *_ in wanted)
    one, two = ({r.id: r for r in session_stats(df, "g", "h", {"x": "w", "y": "v"}, "w", "id", small).collect()} for small in (10**6, 40))
    for i, r in one.items():
        for c, x in r.asDict().items():
            assert x == two[i][c] or x != x or abs(x - two[i][c]) < 1e-9
    plan = G.rank_many(df, "id", specs[:4], 10**6)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Generate" not in plan


def test_asof_moves_times_not_features(spark):
    """Wide features are exchanged once by (key, time) and once to the candidates, whatever the number of passes."""
    from recsignals.operators.asof import asof_join
    from recsignals.operators.asof_many import Source, asof_many

    right = spark.createDataFrame([(1, ts(h), h * 10, -h) for h in (0, 1, 1, 400)] + [(1, ts(1), 99, 0), (None, ts(0), 5, 5), (2, None, 6, 6)], "k long, t timestamp_ntz, x long, y long")
    left = spark.createDataFrame([(i, k, None if h is None else ts(h)) for i, (k, h) in enumerate([(1, 0), (1, 1), (1, 2), (1, 399), (1, 900), (1, 900), (2, 5), (None, 5), (1, None)])], "id long, k long, t timestamp_ntz")
    for strict in (True, False):
        want = {0: None if strict else (0, 0), 1: (0, 0) if strict else (99, 0), 2: (99, 0), 3: (99, 0), 4: (4000, -400), 5: (4000, -400), 6: None, 7: None, 8: None}
        one = asof_join(left, right, ["k"], "t", strict=strict)
        both = asof_many(left, ["k"], "t", [Source(right, ("k",), "t", ("x", "y"), strict), Source(right.select("k", "t", F.col("x").alias("z")), ("k",), "t", ("z",))])
        for r in one.collect():
            assert (None if r.x is None else (r.x, r.y)) == want[r.id]
        for r in both.collect():
            assert (None if r.x is None else (r.x, r.y)) == want[r.id] and r.z == {1: 0, 2: 99, 3: 99, 4: 4000, 5: 4000}.get(r.id)
    plan = one._jdf.queryExecution().sparkPlan().toString()
    assert not any("__v" in line for line in plan.splitlines() if "Window" in line)


def test_asof_of_few_ties_or_few_probes_is_the_same(spark):
    """Neither form sorts the features before their exchange; with few probes the left rows move once."""
    right = spark.createDataFrame([(1, ts(h), h * 10, -h) for h in (0, 1, 1, 400)] + [(1, ts(1), 99, 0), (1, ts(1), None, 1), (None, ts(0), 5, 5), (2, None, 6, 6)], "k long, t timestamp_ntz, x long, y long")
    left = spark.createDataFrame([(i, k, None if h is None else ts(h)) for i, (k, h) in enumerate([(1, 0), (1, 1), (1, 2), (1, 399), (1, 900), (1, 900), (2, 5), (None, 5), (1, None)])], "id long, k long, t timestamp_ntz")
    for strict in (True, False):
        want = sorted(map(tuple, asof_join(left, right, ["k"], "t", strict=strict).collect()))
        for form in ({"few_ties": True}, {"few_probes": True}, {"few_ties": True, "few_probes": True, "times_from": right.select("k", "t")}):
            assert sorted(map(tuple, asof_join(left, right, ["k"], "t", strict=strict, **form).collect())) == want
    plan = asof_join(left, right, ["k"], "t", few_ties=True)._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan


def test_rolling_tables_find_the_row_before_while_rows_are_narrow(spark, log):
    """The latest earlier row comes from a pass below the rolling aggregates, so that these are never exchanged again."""
    from recsignals.operators.history import rolling_table

    out = rolling_table(log, "k", "t", ["24h", "72h"], ["v"], [], aggs=("sum", "std"), ratio_aggs=(), alias="a")
    rows = {(r.k, r.t): r for r in log.collect()}
    for r in out.collect():
        own = sorted(t for k, t in rows if k == r.k and t < r.t)
        assert r.a_v_lag1 == (rows[r.k, own[-1]].v if own else None)
        assert r.a_rolling_sum_v_72h == sum(rows[r.k, t].v for t in own if t >= r.t - dt.timedelta(hours=72))
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert min(i for i, x in enumerate(plan) if "stddev_samp" in x and "Window" in x) < min(i for i, x in enumerate(plan) if "Union" in x)


def test_decay_lambdas_hold_no_aggregates(spark):
    from recsignals.operators.decay import session_decay_history

    logs = spark.createDataFrame([(1, ts(h), float(h * h % 7)) for h in range(20)], "u long, t timestamp_ntz, c double")
    train = spark.createDataFrame([(1, ts(h)) for h in (0, 5, 30)], "u long, t timestamp_ntz")
    out = session_decay_history(train, logs, ["c"], ["u"], "u", "t", alias="x")
    got = {r.t: r for r in out.collect()}
    for h in (5, 30):
        n = 20 if h == 30 else 5
        steps = [(i, float(i * i % 7)) for i in range(n)]
        for k in (3, 12):
            w = [v * 0.5 ** ((n - i) / 3) for i, v in steps[-k:]]
            mean = sum(w) / len(w)
            assert abs(got[ts(h)][f"c_weighted_{k}roll_step_mean_x"] - mean) < 1e-9
            assert abs(got[ts(h)][f"c_weighted_{k}roll_step_std_x"] - (sum((x - mean) ** 2 for x in w) / (len(w) - 1)) ** 0.5) < 1e-9
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # three carried sums, and per window the sum, the mean and the squares: none inside another
    assert plan.count("aggregate(") <= 9
