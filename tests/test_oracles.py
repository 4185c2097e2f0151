"""Registered queries against their DuckDB statements on the smallest tables."""

import pytest

from tests.oracle_check import compare

NAMES = ["q_target_statistics", "q_fold_auc", "q_user_ctr_asof", "q_velocity", "q_category_rank", "q_gender_affinity", "q_category_price", "q_cumulative_history", "q_history_store", "q_decay_single",
         "q_session_rank", "q_auc_ranksum", "q_prediction_csv", "q_target_table", "q_static_features"]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    assert compare(spark, "/root/testdata/sf0.001", [name], verbose=False)[name] is True
