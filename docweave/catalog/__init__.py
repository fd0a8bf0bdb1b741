"""Registered queries: each operator applied to the driver's tables, with DuckDB SQL that says the same where SQL can."""

from __future__ import annotations

from .base import ORACLES, QUERIES
from . import documents, entities, more, relational, rules, text, windows  # noqa: F401  they register their queries

__all__ = ["ORACLES", "QUERIES"]
