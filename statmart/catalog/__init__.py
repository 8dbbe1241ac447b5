"""Every operator run over the test tables, each next to an equivalent plain SQL statement."""

from __future__ import annotations

from . import checks, dimensions, facts, lookups, projections, publishing, releases, sources, stars, texts  # noqa: F401
from .base import REGISTRY, Query

__all__ = ["REGISTRY", "Query"]
