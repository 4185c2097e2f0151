"""Tagged as-of joins and column-driven planning."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recsignals.operators.asof import asof_join
from recsignals.operators.asof_many import Source, asof_many
from recsignals.plans import manifest as M
from recsignals.plans.families import Family


def ts(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


@pytest.fixture(scope="module")
def left(spark):
    rows = [(i, i % 4 or None, ts(i * 11 % 900) if i % 13 else None, i) for i in range(120)] + [(500, 1, ts(30), 1), (501, 1, ts(30), 2)]
    return spark.createDataFrame(rows, "id long, k long, t timestamp_ntz, clash long").repartition(3)


@pytest.fixture(scope="module")
def rights(spark):
    a = spark.createDataFrame([(1, ts(h), h % 7, None if h % 5 else 1.5) for h in range(0, 800, 3)] + [(2, ts(44), 1, 2.0), (None, ts(1), 9, 9.0), (3, None, 1, 1.0)], "k long, t timestamp_ntz, a long, b double")
    b = spark.createDataFrame([(1, ts(33), "x"), (1, ts(33), "y"), (3, ts(0), "z"), (2, ts(44), None)], "key long, day timestamp_ntz, c string")
    return a, b, spark.createDataFrame([], "k long, t timestamp_ntz, d long")


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("width", [None, 5 * 3600 * 10**6])
def test_many_is_each_by_itself(left, rights, strict, width):
    a, b, none = rights
    got = asof_many(left, ["k"], "t", [Source(a, ("k",), "t", ("a", "b"), strict), Source(b, ("key",), "day", ("c",)), Source(none, ("k",), "t", ("d",))], bucket_us=width)
    want = asof_join(left, a, ["k"], "t", strict=strict, right_cols=["a", "b"])
    want = asof_join(want, b.withColumnsRenamed({"key": "k", "day": "t"}), ["k"], "t", right_cols=["c"])
    want = asof_join(want, none, ["k"], "t", right_cols=["d"])
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_one_exchange_of_the_relations(left, rights):
    a, b, _ = rights
    plan = asof_many(left, ["k"], "t", [Source(a, ("k",), "t", ("a",)), Source(a, ("k",), "t", ("b",)), Source(b, ("key",), "day", ("c",))])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") == asof_many(left, ["k"], "t", [Source(a, ("k",), "t", ("a",))])._jdf.queryExecution().executedPlan().toString().count("Window")


def test_columns_that_clash(left, rights):
    with pytest.raises(ValueError):
        asof_many(left, ["k"], "t", [Source(rights[0].withColumnRenamed("a", "clash"), ("k",), "t", ("clash",))])


@pytest.fixture(scope="module")
def manifest(left, rights):
    built = []

    def relation(which):
        def build(spark, cand):
            built.append(which)
            return rights[which].withColumnsRenamed({"key": "k", "day": "t"})
        return build

    fams = [Family("qa", ("k",), "t", "t", relation(0), ("a", "b2"), ("a", "b"), lambda d: d.withColumn("b2", F.col("b") * 2)),
            Family("qb", ("k",), "t", "t", relation(1), ("c",)), Family("qd", ("k",), "t", "t", relation(2), ("d",), fill=0)]
    return M.Manifest(fams, lambda spark: left, ["id"]), built


def test_only_needed_families_are_planned(spark, manifest):
    m, built = manifest
    got = m.table(spark, ["d", "b2"])
    assert got.columns == ["id", "d", "b2"] and set(built) == {0, 2}
    assert {r.d for r in got.collect()} == {0.0}
    assert m.resolve(["b2", "nope", "c"]) == (["b2", "c"], ["nope"])
    with pytest.raises(ValueError):
        m.table(spark, ["nope"])


def test_lists_and_alignment(spark):
    train = spark.createDataFrame([(1, 2.0, "x")], "b int, a double, s string")
    test = spark.createDataFrame([("y", 7, 1.0, 3)], "s string, extra int, b double, a long")
    out = M.align(test, train)
    assert out.columns == ["b", "a", "s"] and [f.dataType for f in out.schema] == [f.dataType for f in train.schema]
    assert tuple(out.first()) == (1, 3.0, "y")
    with pytest.raises(ValueError):
        M.align(test.drop("a"), train)
    assert M.drop(["a", "b", "c"], ["c", "z"], ["a"]) == ["b"] and M.present(train, ["s", "q", "b"]) == ["s", "b"]
