"""Queries over the given tables, each paired with plain SQL to check it."""

from __future__ import annotations

import importlib

MODULES = ("scalars", "intake", "joining", "tracking", "aggregates", "models", "streams")


def load_all() -> None:
    """Import every module that registers queries."""
    for m in MODULES:
        importlib.import_module(f"tarmac.plans.{m}")
