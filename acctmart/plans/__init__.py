"""Business rules and the account extract composed from the operators."""

from acctmart.plans.extract import OUTPUT_COLUMNS, build_extract

__all__ = ["OUTPUT_COLUMNS", "build_extract"]
