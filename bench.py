"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Each query is executed to completion with the ``noop`` sink (no Python-side
collection).  The derived input tables (fixtures) are written once first and
timed separately as ``_fixtures``.  ``value`` is the sum of the query times.
The stacks join families that are timed one by one: they run last and stand
under ``stacks`` with ``stack_seconds``, outside ``value``.
Set BENCH_QUERIES=q1,q2 to run a subset.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def plan(chosen: str) -> tuple[list[str], list[str]]:
    """Queries in the total, and the stacks; a chosen subset counts in the total as it is."""
    from recsignals.plans.catalog import QUERIES
    from recsignals.plans.q_stack import STACKS

    names = [n for n in chosen.split(",") if n]
    return (names, []) if names else ([q for q in QUERIES if q not in STACKS], [q for q in QUERIES if q in STACKS])


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from recsignals.session import get_spark
    from recsignals.plans.catalog import QUERIES
    from recsignals.sources.fixtures import FIXTURE_SQL, register_fixtures

    spark = get_spark(f"local[{cpus}]", int(cpus), app_name="recsignals-bench",
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    names, stacks = plan(os.environ.get("BENCH_QUERIES", ""))

    t0 = time.time()
    register_fixtures(spark, sf_dir, list(FIXTURE_SQL))
    times = {"_fixtures": round(time.time() - t0, 3)}
    errors = {}
    for n in names + stacks:
        t = time.time()
        try:
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[n] = round(time.time() - t, 3)
        except Exception as e:  # keep going; report the failure
            errors[n] = f"{type(e).__name__}: {str(e)[:200]}"
    stack_times = {n: times.pop(n) for n in stacks if n in times}
    total = round(sum(v for k, v in times.items() if not k.startswith("_")), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times,
           "sf": sf, "cpus": int(cpus), "n_queries": len(names)}
    if stacks:
        out |= {"stacks": stack_times, "stack_seconds": round(sum(stack_times.values()), 3)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
