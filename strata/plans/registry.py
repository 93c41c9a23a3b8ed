"""All registered queries and their DuckDB oracle SQL."""

from __future__ import annotations

import importlib

_MODULES = ["strata.plans.sales", "strata.plans.documents", "strata.plans.flights",
            "strata.plans.strings", "strata.plans.demographics", "strata.plans.round_trips"]


def _load():
    queries, oracle = {}, {}
    for name in _MODULES:
        mod = importlib.import_module(name)
        for k, fn in mod.QUERIES.items():
            if k in queries:
                raise ValueError(f"duplicate query {k}")
            queries[k] = fn
        oracle.update(getattr(mod, "ORACLE", {}))
    return queries, oracle


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
