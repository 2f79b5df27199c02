"""Imports every query module so their ``register`` calls fill the registry."""

from baflow.plans import q_call, q_clonal, q_fit, q_phase, q_segment, q_series, q_signals, q_tumour  # noqa: F401
from baflow.plans.registry import REGISTRY, oracle_query, spark_query  # noqa: F401
