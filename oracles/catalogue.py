"""Oracle SQL (DuckDB dialect) per registered query: ``PRELUDE`` (domain tables
derived from the driver tables), the mart's own relations, then one SELECT."""

from __future__ import annotations

from . import marts, units
from .domain import PRELUDE
from .parts import REORDER_CTES


def queries() -> dict[str, str]:
    needs = {
        "reorder_info": [REORDER_CTES],
        "delivery_staging": [marts.STAGING],
        "ticket_info": [marts.STAGING, marts.TICKETS],
        "pooling_summary": [REORDER_CTES, marts.STAGING, marts.TICKETS, marts.SUMMARY],
        "refund_detail": [marts.REFUNDS],
        "refunds_summary": [marts.REFUNDS],
        "order_counts": [marts.REFUNDS],
        "utilisation": [marts.UTILISATION],
    }
    found = {mart: PRELUDE + "".join(parts) + f"\nSELECT * FROM {mart}" for mart, parts in needs.items()}
    return found | units.queries()
