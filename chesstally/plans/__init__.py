"""Ingest plans: dump index parsing, month bounds, exclusion of ingested months."""

from chesstally.plans.ingest import (
    INDEX_LINE_PATTERN,
    build_plan,
    exclude_done,
    filter_months,
    order_plan,
    parse_index,
    read_index,
)

__all__ = [
    "INDEX_LINE_PATTERN",
    "build_plan",
    "exclude_done",
    "filter_months",
    "order_plan",
    "parse_index",
    "read_index",
]
