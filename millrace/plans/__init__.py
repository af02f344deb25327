"""Registered queries, grouped by subject, each next to its SQL oracle."""

from __future__ import annotations

import importlib

from millrace.registry import QUERIES, Query

SUBJECTS = ("sales", "ordered", "quality", "cleaning", "scalars", "detection", "text", "learning", "sources", "streams")


def load_all() -> dict[str, Query]:
    """Import every subject module and return the registry."""
    for subject in SUBJECTS:
        importlib.import_module(f"millrace.plans.{subject}")
    return QUERIES
