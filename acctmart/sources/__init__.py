"""Reading the input tables, checking their columns, and writing results."""

from acctmart.sources.contract import COLUMNS, require_columns, require_contract
from acctmart.sources.io import load_tables, save_bucketed, write_extract

__all__ = [
    "COLUMNS",
    "load_tables",
    "require_columns",
    "require_contract",
    "save_bucketed",
    "write_extract",
]
