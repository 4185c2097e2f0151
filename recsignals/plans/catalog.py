"""Imports every query module so the registry is complete."""

from recsignals.plans import q_affinity, q_catalog, q_counters, q_decay, q_history, q_ranking, q_session  # noqa: F401
from recsignals.plans import q_stack  # noqa: F401  (joins the others)
from recsignals.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
