"""All registered queries."""

from __future__ import annotations

import importlib

from marketlens.plans.registry import QUERIES, SQL

MODULES = ("lifecycle_queries", "listing_queries", "market_queries", "page_queries", "health_queries")

for _name in MODULES:
    importlib.import_module(f"marketlens.plans.{_name}")

__all__ = ["QUERIES", "SQL"]
