"""Named queries: each pairs a Spark plan over the driver's tables with its SQL check."""

from __future__ import annotations

from importlib import import_module

from ledgerloom.plans.registry import ORACLES, QUERIES

MODULES = ["loading", "revenue", "pricing", "customers", "products", "cleaning", "exploring", "live"]


def load_all() -> None:
    for name in MODULES:
        import_module(f"ledgerloom.plans.{name}")


__all__ = ["ORACLES", "QUERIES", "load_all"]
