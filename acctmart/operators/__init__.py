"""DataFrame operators: newest rows, joins, aggregates and lookups."""

from acctmart.operators.aggregates import (
    count_related,
    date_aggregates,
    first_last_dates,
    has_related,
    join_long_text,
    join_text,
    join_texts,
    month_offset_pivot,
    ordered_text,
)
from acctmart.operators.as_of import newest_as_of, over_dates
from acctmart.operators.fused import FirstRow, fused, newest
from acctmart.operators.joins import (
    assert_unique,
    attach,
    attach_dimension,
    attach_fan_out,
    attach_spread,
    fits_broadcast,
)
from acctmart.operators.lookups import latest_status_count, lookup_name, top1_lookup
from acctmart.operators.newest import any_per_key, latest_per_key

__all__ = [
    "join_long_text",
    "newest_as_of",
    "over_dates",
    "date_aggregates",
    "FirstRow",
    "fused",
    "newest",
    "ordered_text",
    "any_per_key",
    "assert_unique",
    "attach",
    "attach_dimension",
    "attach_fan_out",
    "attach_spread",
    "count_related",
    "first_last_dates",
    "fits_broadcast",
    "has_related",
    "join_text",
    "join_texts",
    "latest_per_key",
    "latest_status_count",
    "lookup_name",
    "month_offset_pivot",
    "top1_lookup",
]
