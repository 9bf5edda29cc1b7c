"""Every operator and report bound to the test tables."""

from __future__ import annotations

import importlib

MODULES = ("lookups", "columns", "relational", "reports")


def all_cases():
    from stockledger.cases.registry import CASES

    for module in MODULES:
        importlib.import_module(f"stockledger.cases.{module}")
    return dict(CASES)
