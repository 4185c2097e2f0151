"""Correlations against numpy, and their width."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsignals.operators import selection as S


def pairwise(x):
    k = x.shape[1]
    out = np.zeros((k, k))
    for i in range(k):
        for j in range(k):
            own = x[~np.isnan(x[:, i]) & ~np.isnan(x[:, j])][:, [i, j]]
            if len(own) > 1 and own.std(0).min() > 0:
                out[i, j] = abs(np.corrcoef(own.T)[0, 1])
    return out


@pytest.fixture(scope="module")
def data():
    r = np.random.default_rng(3)
    x = r.normal(0, 1, (900, 70))
    x[:, 1] = x[:, 0] * 3 + 1e9
    x[:, 2] = x[:, 0] + r.normal(0, 0.05, 900)
    x[:, 3] = 7.25  # constant
    x[r.random(x.shape) < 0.1] = np.nan
    x[:, 4] = np.nan  # never a value
    x[1:, 5] = np.nan
    return x


def frame(spark, x):
    return spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in x], ", ".join(f"`f {i}` double" for i in range(x.shape[1]))).repartition(3)


def test_pairs_with_missing_values(spark, data, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_COLUMNS", 16)
    monkeypatch.setattr(S, "BLOCK_ROWS", 50)
    got = S.correlations(frame(spark, data), [f"f {i}" for i in range(data.shape[1])])
    assert np.abs(got - pairwise(data)).max() < 1e-6


def test_choice(spark, data):
    df = frame(spark, data)
    got = {r.feature: r for r in S.prune_correlated(df, [f"f {i}" for i in range(10)], "f 10", 0.98).collect()}
    gone = [f for f, r in got.items() if not r.kept]
    assert len(gone) == 2 and set(gone) < {"f 0", "f 1", "f 2"} and got["f 3"].target_corr == 0
    assert all(got[got[f].dropped_for].kept or got[f].dropped_for in gone for f in gone)


def test_six_hundred_columns_in_one_pass(spark):
    k = 600
    wide = spark.range(4000).select(*[_column(i).alias(f"c{i}") for i in range(k)])
    got = S.correlations(wide, [f"c{i}" for i in range(k)])
    assert got.shape == (k, k) and np.allclose(np.diag(got), 1) and got[0, 300] > 0.999999


def _column(i):
    base = F.pmod(F.xxhash64("id", F.lit(i % 300)), F.lit(1000)).cast("double")
    return base * (1 + i)


def test_empty(spark):
    none = spark.createDataFrame([], "a double, b double")
    assert [r.kept for r in S.prune_correlated(none, ["a"], "b").collect()] == [1]
