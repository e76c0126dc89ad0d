"""All queries outside the llm subpackage, by name."""

from __future__ import annotations

from ..operators import heavy_keys, nested
from . import derep, geometry, relational, stages, viral  # noqa: F401
from .base import ORACLES, QUERIES, query
from .p_sql import SQL

FLAGSHIP = "greedy_clusters"
for f in (heavy_keys.p3_found, heavy_keys.p3_taxa, nested.p5_found, nested.p5_records):
    query(SQL[f.__name__])(f)
