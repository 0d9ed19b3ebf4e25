"""Registered queries: each binds an operator to the test tables and carries
the DuckDB SQL that checks it."""

import importlib

_MODULES = ("fairness_q", "clean_q", "sampling_q", "weights_q", "encode_q", "drift_q", "metrics_q", "monitor_q", "explain_q", "stream_q", "models_q", "sources_q", "cases_q", "neighbors_q", "stages_q")


def load_all():
    from trustframe.plans import registry
    for m in _MODULES:
        importlib.import_module(f"trustframe.plans.{m}")
    return registry.QUERIES, registry.ORACLE
