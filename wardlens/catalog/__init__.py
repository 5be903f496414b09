"""Registered queries: each runs over inputs derived from the whole source tables."""

from __future__ import annotations

from wardlens.catalog.analytics import ANALYTICS
from wardlens.catalog.bronze import BRONZE
from wardlens.catalog.inputs import Query
from wardlens.catalog.relational import RELATIONAL

CATALOG: dict[str, Query] = {**RELATIONAL, **ANALYTICS, **BRONZE}
top_critical = CATALOG["d10_top_critical"]
