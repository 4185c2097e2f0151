"""The default bench runs every registered query of the ranking features."""

import bench
from recsignals.plans.catalog import QUERIES


def test_all_queries_run():
    names, stacks = bench.plan("")
    assert sorted(names + stacks) == sorted(QUERIES) and stacks == ["q_stack_a", "q_stack_b"]
    assert bench.plan("q_stack_b,q_blend") == (["q_stack_b", "q_blend"], [])
