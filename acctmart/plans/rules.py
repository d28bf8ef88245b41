"""Business rules of the account extract as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from acctmart.functions import flag_yn, fold, iso_date, same_text

# Status codes, product types and texts of the loan book.
LITIGATION_START = (
    17, 18, 19, 20, 21, 22, 23, 25, 27, 28, 29,
    42, 43, 44, 45, 46, 47, 48, 49, 50, 51, 71,
)
LITIGATION_END = (31, 32, 33, 34, 35, 36, 37, 38)
PRE_LITIGATION_START = (9, 10, 11, 12, 13)
PRE_LITIGATION_END = (42, 49)
LEGAL_CODES = tuple(
    sorted({*LITIGATION_START, *LITIGATION_END, *PRE_LITIGATION_START, *PRE_LITIGATION_END})
)
FIXED_RATE_PRODUCTS = ("fixed", "fixed (mars)", "fixed (sco22)", "staff")
CUSTOMER_PREFIXES = {"URI_%": "1", "UFA_%": "2"}
DEFAULT_ORIGINATOR = "ULSTER BANK"
ARA_INTEREST_ONLY = 4
DD_ACTIVE = 2
GUARANTOR_TYPE = 3
MARP_CURRENT = (3, 4)
MARP_OUT = 1
MARP_PRE_ARREARS = 4
PAYMENT_CATEGORY = "pmt"
SECURITY_RELEASED = 6

LITIGATION_DATES = {
    "LTGTN_START_DTE": ("min", LITIGATION_START),
    "LTGTN_END_DTE": ("max", LITIGATION_END),
    "PRE_LTGTN_START_DTE": ("min", PRE_LITIGATION_START),
    "PRE_LTGTN_END_DTE": ("max", PRE_LITIGATION_END),
}


def _lower(text: Column, ci: bool) -> Column:
    """These rules never regard case; with ``ci``, trailing blanks neither."""
    return fold(text) if ci else F.lower(text)


def is_fixed_rate(product: Column, ci: bool = False) -> Column:
    return _lower(product, ci).isin(*FIXED_RATE_PRODUCTS)


def rate_kind(product: Column, ci: bool = False) -> Column:
    """F for fixed-rate products, else V (also where unknown)."""
    return flag_yn(is_fixed_rate(product, ci), "F", "V")


def is_interest_only(method: Column, ci: bool = False) -> Column:
    return _lower(method, ci) == "interest only"


def interest_only_day(
    product: Column, method: Column, fixed_until: Column, maturity: Column, ci: bool = False
) -> Column:
    """Last day of the interest-only time: that of the fixed rate, else maturity."""
    fixed = F.when(is_fixed_rate(product, ci), fixed_until.cast("date"))
    return F.when(is_interest_only(method, ci), fixed.otherwise(maturity.cast("date")))


def interest_only_end(
    product: Column, method: Column, fixed_until: Column, maturity: Column, ci: bool = False
) -> Column:
    """The same day as text."""
    return iso_date(interest_only_day(product, method, fixed_until, maturity, ci))


def is_payment(category: Column, ci: bool = False) -> Column:
    return _lower(category, ci) == PAYMENT_CATEGORY


def is_set(flag: Column) -> Column:
    """A flag of 1, whether its column is a number or a boolean."""
    return flag.cast("int") == 1


def arranged_end(option: Column, arranged: Column, otherwise: Column) -> Column:
    """The end of an interest-only arrangement, where the newest one is of that kind."""
    return F.when(option == ARA_INTEREST_ONLY, arranged).otherwise(otherwise)


def marp_day(marp_type: Column, changed_on: Column) -> Column:
    """Day of the newest entry if it is a current or an exit entry.

    The newest entry of its own type is then that entry, so no second lookup is needed.
    """
    return F.when(marp_type.isin(MARP_OUT, *MARP_CURRENT), changed_on.cast("date"))


def marp_date(marp_type: Column, changed_on: Column) -> Column:
    """The same day as text."""
    return iso_date(marp_day(marp_type, changed_on))


def marp_flag(
    marp_type: Column, regulator: Column, purpose: Column, arrears: Column, ci: bool = False
) -> Column:
    """M current, O out, N not entered though a buy-to-let case in arrears; else NULL."""
    return (
        F.when(marp_type.isin(*MARP_CURRENT), "M")
        .when(marp_type == MARP_OUT, "O")
        .when((regulator == 2) & (_lower(purpose, ci) == "btl") & (arrears > 0), "N")
    )


def marp_ind(marp_type: Column) -> Column:
    return flag_yn(marp_type.isin(*MARP_CURRENT))


def pre_arrears(marp_type: Column) -> Column:
    return F.when(marp_type == MARP_PRE_ARREARS, "Y")


def payment_method(mandate_status: Column, description: Column, ci: bool = False) -> Column:
    """Direct debit by mandate or by the newest payment, else that payment's description."""
    paid_by_debit = same_text(description, F.lit("Direct Debit Payment"), ci)
    return F.when((mandate_status == DD_ACTIVE) | paid_by_debit, "Direct Debit").otherwise(
        description
    )


def close_day(status: Column, effective: Column, ci: bool = False) -> Column:
    return F.when(_lower(status, ci) == "redeemed", effective.cast("date"))


def close_date(status: Column, effective: Column, ci: bool = False) -> Column:
    """The same day as text."""
    return iso_date(close_day(status, effective, ci))


def term_unit(frequency: Column, ci: bool = False) -> Column:
    """Y for yearly payments, else M (also where unknown)."""
    return flag_yn(same_text(frequency, F.lit("Annually"), ci), "Y", "M")


def legal_description(code: Column, description: Column) -> Column:
    return F.when(code.isin(*LEGAL_CODES), description)
