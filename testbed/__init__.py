"""Input tables and queries over the given data."""

from __future__ import annotations

import importlib

MODULES = ("q_events", "q_scale", "q_retail", "q_operators")


def all_queries():
    """The registry with every query module loaded."""
    from testbed.registry import REGISTRY

    for m in MODULES:
        importlib.import_module(f"testbed.{m}")
    return REGISTRY
