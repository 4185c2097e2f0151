"""Stored histories: appended days equal a full rebuild, both candidate tables read the same store."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from recsignals.functions.expr import DAY_US
from recsignals.operators.asof import asof_join
from recsignals.operators.frames import running_agg
from recsignals.operators.history_store import HistoryStore

MEASURES = [("total", "sum", "a"), ("top", "max", "b"), ("low", "min", "b"), ("known", "count", "a"), ("rows", "count", None)]


def ts(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


@pytest.fixture(scope="module")
def log(spark):
    # Key 1 holds a third of all rows, some at one time; key 9 comes with the last day only; nulls everywhere.
    rows = [(1 if i % 3 == 0 else i % 7, ts(i * 5 % 960), None if i % 11 == 0 else i % 13, None if i % 4 else float(i % 17)) for i in range(900)]
    rows += [(9, ts(950), 5, 1.0), (None, ts(3), 7, 7.0), (2, None, 7, 7.0), (1, ts(30), 2, 3.0), (1, ts(30), 2, 3.0)]
    return spark.createDataFrame(rows, "k long, t timestamp_ntz, a long, b double").cache()


@pytest.fixture(scope="module")
def candidates(spark):
    rows = [(i, i % 11 or None, ts(i * 7 % 1100) if i % 19 else None, i) for i in range(300)] + [(900, 1, ts(30), 1), (900, 1, ts(30), 1)]
    return spark.createDataFrame(rows, "id long, key long, at timestamp_ntz, total_before long")


def store(spark, parts, **kw):
    s = HistoryStore(spark, ["k"], "t", MEASURES, buckets=5, **kw)
    for part in parts:
        s.append(part)
    return s


def cut(log, *hours):
    edges = [-1, *hours, 10**6]
    return [log.where((F.col("t") >= F.lit(ts(a))) & (F.col("t") < F.lit(ts(b)))) for a, b in zip(edges, edges[1:])]


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def test_appended_days_equal_a_rebuild(spark, log):
    whole = store(spark, [log])
    by_day = store(spark, cut(log, 300, 301, 936))
    assert rows(by_day.rows()) == rows(whole.rows())


def test_states_are_running_aggregates(spark, log):
    one = log.na.drop(subset=["k", "t"])
    want = running_agg(one, ["k"], "t", [("total", "sum", "a"), ("top", "max", "b"), ("low", "min", "b"), ("known", "count", "a"), ("rows", "count", "k")])
    assert rows(store(spark, cut(log, 500)).rows()) == rows(want.select("k", "t", *[n for n, _, _ in MEASURES]).distinct())


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("width", [DAY_US, 7 * DAY_US])
def test_attach_is_the_as_of_join(spark, log, candidates, strict, width):
    s = store(spark, cut(log, 400, 936), bucket_us=width)
    got = s.attach(candidates, ["key"], "at", strict)
    want = asof_join(candidates, s.rows().withColumnsRenamed({"k": "key", "t": "at"}), ["key"], "at", strict=strict, right_cols=s.names)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_a_broken_append_is_repeated(spark, log):
    first, second = cut(log, 900)
    s = store(spark, [first, second])
    want = rows(s.rows())
    s.append(second)
    assert rows(s.rows()) == want
    with pytest.raises(ValueError):
        s.append(first)
    with pytest.raises(ValueError):
        s.append(second.where(F.col("t") >= F.lit(ts(930))).withColumn("t", F.col("t") - F.expr("INTERVAL 5 DAYS")))
    assert rows(s.append(log.limit(0)).rows()) == want


def test_stored_rows_are_not_moved(spark, log, candidates):
    s = store(spark, cut(log, 900))
    plan = s.attach(candidates, ["key"], "at")._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    depth = lambda line: len(re.match(r"[\s:|+\-*()\d]*", line).group())
    scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line and s.name in line]
    assert len(scans) == 2 and all("Bucketed: true" in lines[i] for i in scans)
    for i in scans:  # walk up to the window over the union: no exchange between
        at, d = i, depth(lines[i])
        while "Window" not in lines[at]:
            at -= 1
            if depth(lines[at]) < d:
                d = depth(lines[at])
                assert "Exchange" not in lines[at], plan


def test_empty_log_and_candidates(spark, log, candidates):
    s = store(spark, [log])
    assert s.attach(candidates.limit(0), ["key"], "at").count() == 0
    assert s.attach(candidates, ["key"], "at").count() == candidates.count()
