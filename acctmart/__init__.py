"""Newest-state account extracts as Spark DataFrame operators."""

from acctmart.operators import (
    any_per_key,
    attach,
    attach_dimension,
    attach_fan_out,
    attach_spread,
    count_related,
    first_last_dates,
    has_related,
    join_text,
    join_texts,
    latest_per_key,
    latest_status_count,
    lookup_name,
    month_offset_pivot,
    top1_lookup,
)
from acctmart.plans import build_extract
from acctmart.sources import load_tables, require_columns, save_bucketed, write_extract

__all__ = [
    "any_per_key",
    "attach",
    "attach_dimension",
    "attach_fan_out",
    "attach_spread",
    "build_extract",
    "count_related",
    "first_last_dates",
    "has_related",
    "join_text",
    "join_texts",
    "latest_per_key",
    "latest_status_count",
    "load_tables",
    "lookup_name",
    "month_offset_pivot",
    "require_columns",
    "save_bucketed",
    "top1_lookup",
    "write_extract",
]
