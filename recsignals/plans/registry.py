"""Query registry: name -> (spark builder, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recsignals.functions.expr import finalize
from recsignals.sources.fixtures import fixture_cte, register_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: name -> (fixtures, DuckDB text without their definitions), for statements that are put together from others.
BODIES: dict[str, tuple[tuple[str, ...], str]] = {}


def query(name: str, fixtures: tuple[str, ...] = (), oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``.  ``oracle`` is the DuckDB
    body; the fixture CTEs are prepended to it.  Outputs pass through
    :func:`finalize` (rounded doubles, BIGINT integers)."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            register_fixtures(spark, sf_dir, list(fixtures))
            return finalize(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            BODIES[name] = (tuple(fixtures), oracle.strip())
            ORACLES[name] = (fixture_cte(fixtures) if fixtures else "") + oracle.strip()
        return run

    return deco
