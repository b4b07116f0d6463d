"""All registered queries: name -> (Spark callable, DuckDB SQL or None)."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "flows",
    "keys_quality",
    "snapshots",
    "mutations",
    "evaluation_drift",
    "reports_queries",
    "scoring_governance",
    "streams_models",
    "late_events",
)


def registered() -> dict:
    found: dict = {}
    for name in MODULES:
        for key, entry in import_module(f"workload.{name}").QUERIES.items():
            if key in found:
                raise ValueError(f"query {key} is registered twice")
            found[key] = entry
    return found
