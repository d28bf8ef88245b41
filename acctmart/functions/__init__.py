"""Column rules: text, calendar, number and flag expressions."""

from acctmart.functions.dates import (
    as_date,
    days_since,
    iso_date,
    month_boundaries,
    month_start,
    next_due_date,
)
from acctmart.functions.flags import clamp_min, flag_yn, or_default, raise_if
from acctmart.functions.numbers import fixed2, int_text, percent_text
from acctmart.functions.text import (
    account_number,
    after_last,
    before_first,
    concat_blank,
    fold,
    recode_prefix,
    same_text,
    split_reference,
    text_length,
)

__all__ = [
    "account_number",
    "after_last",
    "as_date",
    "before_first",
    "clamp_min",
    "concat_blank",
    "days_since",
    "fixed2",
    "flag_yn",
    "fold",
    "int_text",
    "iso_date",
    "month_boundaries",
    "month_start",
    "next_due_date",
    "or_default",
    "percent_text",
    "raise_if",
    "recode_prefix",
    "same_text",
    "split_reference",
    "text_length",
]
