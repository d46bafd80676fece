"""Registered queries, one module per operator family."""

import importlib

from priorframe.plans.registry import ORACLES, QUERIES

for _name in (
    "sources", "cleaning", "joins", "aggregates", "history", "labels", "splits",
    "gate", "probes", "metrics", "predictors", "streams", "reports",
):
    importlib.import_module(f"priorframe.plans.{_name}")

from priorframe.plans.labels import flagship  # noqa: E402

__all__ = ["ORACLES", "QUERIES", "flagship"]
