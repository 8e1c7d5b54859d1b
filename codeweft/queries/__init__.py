"""Registered queries, each next to the SQL that checks it."""

from __future__ import annotations

from codeweft.queries import code, files, graph, log, scalars, state, streams  # noqa: F401
from codeweft.queries.base import REGISTRY, SQL

__all__ = ["REGISTRY", "SQL"]
