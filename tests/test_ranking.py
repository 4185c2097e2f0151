"""Folds, AUC by group, categories from the past, the two rankers: against plain Python on small frames."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from recsignals.operators.categories import fill_categories, target_statistics
from recsignals.operators.evaluate import auc_by, mean_auc, time_folds
from recsignals.operators.ranker import importance_cut, listwise_gradient, score, train_grouped_ranker, train_session_ranker
from recsignals.operators.session import downsample_negatives, session_rank


def day(n, hour=0):
    return dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=n)


def test_folds_expand_and_never_look_ahead(spark):
    rows = [(i, day(i // 3, i % 3)) for i in range(3 * 10)] + [(99, None)]
    out = time_folds(spark.createDataFrame(rows, "id long, t timestamp_ntz"), "t", 3).collect()
    for f in (1, 2, 3):
        train = {r.t.date() for r in out if r.fold == f and not r.is_validation}
        valid = {r.t.date() for r in out if r.fold == f and r.is_validation}
        assert train and valid and max(train) < min(valid)
    # ten days in four runs: 3, 3, 2, 2
    assert [len({r.t.date() for r in out if r.fold == f and r.is_validation}) for f in (1, 2, 3)] == [3, 2, 2]
    assert len(out) == len({(r.id, r.fold) for r in out}) and 99 not in {r.id for r in out}
    empty = spark.createDataFrame([], "id long, t timestamp_ntz")
    assert time_folds(empty, "t").count() == 0


def test_auc_by_group(spark):
    rng = random.Random(3)
    rows = [(g, rng.choice([0.0, 0.5, 0.5000001, 2.0]), rng.random() < 0.4) for g in ("a", "b", None) for _ in range(60)] + [("one", 1.0, True)]
    df = spark.createDataFrame([(g, s, int(y)) for g, s, y in rows], "g string, s double, y int")
    by = auc_by(df, ["g"], "s", "y")
    got = {r.g: r.auc for r in by.collect()}
    for g in ("a", "b", None):
        p, n = [s for h, s, y in rows if h == g and y], [s for h, s, y in rows if h == g and not y]
        assert abs(got[g] - sum((a > b) + 0.5 * (a == b) for a in p for b in n) / len(p) / len(n)) < 1e-12
    assert got["one"] is None
    mean = mean_auc(by).first()
    assert mean.n_groups == 3 and abs(mean.mean_auc - sum(got[g] for g in ("a", "b", None)) / 3) < 1e-12


def _categories(spark, rows):
    df = spark.createDataFrame(rows, "id long, t timestamp_ntz, c string, d string, y double")
    df = fill_categories(df, ["c", "d"], "UNKNOWN")
    return {r.id: (r.c_past_target, r.d_past_target) for r in target_statistics(df, ["c", "d"], "y", "t", "id").collect()}


def test_target_statistics_see_only_the_past(spark):
    rng = random.Random(5)
    rows = [(i, day(rng.randrange(40), rng.randrange(3)), rng.choice(["x", "y", None]), rng.choice("pq"), float(rng.randrange(4))) for i in range(200)]
    got = _categories(spark, rows)
    for i, t, c, _, _ in rows:
        past = [r for r in rows if r[1] < t]
        prior = sum(r[4] for r in past) / len(past) if past else 0.0
        own = [r[4] for r in past if r[2] == c]
        assert abs(got[i][0] - (sum(own) + prior) / (len(own) + 1)) < 1e-9
    # leakage: other labels at or after a time change nothing up to it
    cut = day(20)
    changed = [(i, t, c, d, y if t < cut else 100.0 - y) for i, t, c, d, y in rows]
    after = _categories(spark, changed)
    assert all(got[r[0]] == after[r[0]] for r in rows if r[1] <= cut)
    # a category not seen before reads the mean of all earlier rows
    new = _categories(spark, rows + [(900, day(60), "new", "new", 1.0)])[900]
    assert all(abs(v - sum(r[4] for r in rows) / len(rows)) < 1e-9 for v in new)


@pytest.fixture(scope="module")
def sessions(spark):
    """Session level decides most of the target, x who is best inside a session; one x is missing."""
    rng = random.Random(11)
    rows = []
    for s in range(120):
        level = rng.random()
        for i in range(8):
            x = rng.random()
            rows.append((s * 8 + i, s, level, None if (s, i) == (0, 0) else x, 20 * level + (x > 0.7), int(x > 0.7)))
    return spark.createDataFrame(rows, "id long, s long, level double, x double, target double, best int")


def test_grouped_ranker_beats_pointwise_inside_sessions(spark, sessions):
    train, held = sessions.where("s < 90"), sessions.where("s >= 90")
    grouped = train_grouped_ranker(train, "s", ["level", "x"], "target", rounds=3, depth=1)
    pointwise = train_session_ranker(train, ["level", "x"], "target", max_iter=3, depth=1)
    labels = held.select("id", "best")
    auc = lambda scored: mean_auc(auc_by(scored.join(labels, "id"), ["s"], "prediction", "best")).first().mean_auc
    a, b = auc(grouped.score(held, ["id", "s"])), auc(score(pointwise, held, ["level", "x"], ["id", "s"]))
    assert a > 0.95 and a > b + 0.2


def test_grouped_ranker_cases(spark, sessions):
    none = train_grouped_ranker(sessions.withColumn("target", F.lit(0.0)), "s", ["x"], "target", rounds=2)
    assert none.trees == [] and {r.prediction for r in none.score(sessions, ["id"]).collect()} == {0.0}
    assert train_grouped_ranker(sessions.limit(0), "s", ["x"], "target", rounds=2).trees == []
    g = listwise_gradient(sessions.withColumn("now", F.lit(0.0)), "s", "target", "now")
    for r in g.groupBy("s").agg(F.sum(F.col("__g") * F.col("__h")).alias("total")).collect():
        assert abs(r.total) < 1e-9  # a session's gradients cancel
    model = train_grouped_ranker(sessions, "s", ["x"], "target", rounds=2, depth=2)
    kept = model.score(sessions, ["id", "x"])  # a feature may be kept as well; a missing one has a score
    assert kept.columns == ["id", "x", "prediction"] and kept.where("prediction IS NULL").count() == 0


def test_importance_cut_keeps_the_first_share(spark, sessions):
    d = sessions.withColumn("noise", F.lit(1.0))
    rows = importance_cut(spark, train_session_ranker(d, ["noise", "level", "x"], "target", max_iter=2, depth=3), ["noise", "level", "x"], 0.5).collect()
    assert rows[0].feature == "level" and abs(sum(r.importance for r in rows) - 1) < 1e-9
    before = 0.0
    for r in rows:
        assert r.kept == int(before < 0.5)
        before += r.importance


def test_tied_scores_are_ranked_by_item(spark):
    rows = [(1, i, 5.0) for i in range(300)] + [(1, i, 7.0) for i in range(300, 310)] + [(None, 4, None), (None, 3, None), (None, 9, 1.0), (2, 5, 1.0), (2, 5, 1.0), (2, 8, 1.0)]
    random.Random(1).shuffle(rows)
    got = sorted((r.s or 0, r["rank"], r.i) for r in session_rank(spark.createDataFrame(rows, "s long, i long, v double"), "s", "i", "v").collect())
    want = [(0, 1, 9), (0, 2, 3), (0, 3, 4)] + [(1, k + 1, 300 + k) for k in range(10)] + [(1, k + 11, k) for k in range(300)] + [(2, 1, 5), (2, 1, 5), (2, 3, 8)]
    assert got == want


def test_downsampling_of_1001_negatives_by_hash(spark):
    df = spark.range(1001).select(F.lit(1).alias("s"), F.col("id").alias("i"), F.lit(0).alias("y")).unionByName(spark.createDataFrame([(1, 5000, 1), (2, 1, 0)], "s int, i long, y int"))
    once = downsample_negatives(df, "s", ["y"], 1000)
    ids = {(r.s, r.i) for r in once.collect()}
    assert len(ids) == 1002 and {(1, 5000), (2, 1)} <= ids
    assert ids == {(r.s, r.i) for r in downsample_negatives(df.repartition(7), "s", ["y"], 1000).collect()}


def test_trees_are_fitted_on_bounded_partitions(spark):
    from recsignals.operators.ranker import bounded_partitions

    d = spark.range(1000).coalesce(1)
    assert bounded_partitions(d, 100).rdd.getNumPartitions() == 10 and bounded_partitions(d, 100).count() == 1000
    assert bounded_partitions(d, 1000).rdd.getNumPartitions() == 1


def test_task_share_is_bounded_as_tables_grow(spark, tmp_path):
    from recsignals import session as S

    kept = {c: spark.conf.get(c, None) for c in ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")}
    spark.range(200_000).selectExpr("id", "uuid() AS u").write.parquet(f"{tmp_path}/t")
    S.bound_tasks(spark, [f"{tmp_path}/t"] * 20)
    parts = int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum"))
    assert 20 <= parts < 60
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(S.TASK_BYTES)
    for c, v in kept.items():
        spark.conf.unset(c) if v is None else spark.conf.set(c, v)
