"""The queries of this subpackage, by name."""

from __future__ import annotations

from . import canonical, groups, leaks, subset, survivor, tokens
from .sql import SQL

QUERIES = {
    f.__name__: f
    for f in (
        subset.p1_found, subset.p1_subset, groups.p2_found, survivor.p4_found, survivor.p4_currency,
        tokens.p6_ids, tokens.p6_roundtrip, leaks.p7_found, leaks.p7_covered, canonical.p8_found, canonical.p8_canonical,
    )
}
ORACLES = SQL
