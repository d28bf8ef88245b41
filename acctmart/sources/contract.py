"""The input contract: the tables of a loan book and the columns that are read."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegralType,
    LongType,
    MapType,
    NullType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from acctmart.functions.flags import raise_if

# Table and column names of the loan book.
COLUMNS: dict[str, tuple[str, ...]] = {
    "Applicant_TBL": ("CaseID", "BorrowerID", "First name", "Surname", "WithholdCommunication"),
    "AraHistory": ("CaseID", "EffectiveDate", "DSTResolutionOptionID", "ProjectedEndDate"),
    "CMSHistory_TBL": ("CaseID", "CMS Month", "CMS"),
    "CaseInformation": (
        "CaseID", "CurBal", "OutstandingArrears", "MaturityDate", "DateFirstInArrears",
        "CurrentRateEffectiveDate", "PayRateNow", "AibProductCode", "ArrearsLME",
    ),
    "CaseSecurity": ("CaseID", "SecurityID"),
    "Case_TBL": (
        "CaseID", "AccountNumber", "CaseReference", "Original Reference", "PaymentDay",
        "RegulatoryBodyId", "PurposeCode", "SectorCode",
    ),
    "CreditGrade": ("CaseID", "Grade", "DateOfChange"),
    "Customer Details": ("Customer ID", "Borrower Residency"),
    "DV_LoanTermRemaining": ("CaseID", "Remaining term"),
    "DirectDebitInstructions": (
        "CaseID", "DDStatusID", "NextCollection", "BIC", "SortCode", "IBAN",
    ),
    "Facilitator": ("CaseID", "FacilitatorTypeID"),
    "Index_TBL": ("IndexID", "Index rate", "ProductType", "Index name"),
    "Loan Details": ("Loan ID", "Sub Loan ID", "Origination Date"),
    "Loan_TBL": (
        "CaseID", "AIBCompletionDate", "Original loan amount", "FirstTimeBuyer",
        "PaymentFrequencyID", "Repayment method", "CreditGradeOverride", "Currency", "Purpose",
        "Originator", "Completion Date",
    ),
    "MarpTypeHistory": ("CaseID", "ChangedOnDate", "MarpTypeID"),
    "MonthlyBalances_TBL": ("CaseID", "Date", "Arrears"),
    "PaymentFrequency": ("Id", "Name"),
    "Rate_TBL": ("CaseID", "IndexID", "Period 1 end"),
    "ReceivedDue_TBL": ("CaseID", "Month end", "Payments received"),
    "SecurityStatusHistory": ("SecurityID", "EffectiveDate", "StatusID"),
    "StatusHistory_TBL": ("CaseID", "Datechanged", "Effective date", "StatusID"),
    "StatusSecondary": ("CaseID", "StatusSecondaryTypeID", "EffectiveDate", "ChangedOnDate"),
    "StatusSecondaryType": ("StatusSecondaryTypeID", "StatusDescription"),
    "Status_TBL": ("StatusID", "Status"),
    "TransactionType_TBL": (
        "TransactionTypeID", "Transaction category", "Transaction description",
    ),
    "Transaction_TBL": ("CaseID", "TransactionTypeId", "Transaction date", "Transaction amount"),
}

# Joined by key alone and never read: unique on CaseId, so the result is the same without it.
UNREAD: dict[str, tuple[str, ...]] = {"MissedOrLatePayments": ("CaseId",)}


# What a column holds, where it isn't a key or a code that any plain type may hold.
DATES = frozenset((
    "AIBCompletionDate", "CMS Month", "ChangedOnDate", "Completion Date", "CurrentRateEffectiveDate",
    "Date", "DateFirstInArrears", "DateOfChange", "Datechanged", "Effective date", "EffectiveDate",
    "MaturityDate", "Month end", "NextCollection", "Origination Date", "Period 1 end",
    "ProjectedEndDate", "Transaction date",
))
NUMBERS = frozenset((
    "Arrears", "ArrearsLME", "CMS", "CurBal", "Index rate", "Original loan amount",
    "OutstandingArrears", "PayRateNow", "PaymentDay", "Payments received", "Remaining term",
    "SectorCode", "Transaction amount",
))
FLAGS = frozenset(("FirstTimeBuyer", "WithholdCommunication"))
TEXTS = frozenset((
    "AccountNumber", "BIC", "Borrower Residency", "BorrowerID", "CaseReference", "Customer ID", "First name",
    "IBAN", "Index name", "Loan ID", "Name", "Original Reference", "ProductType", "Purpose",
    "Repayment method", "SortCode", "Status", "StatusDescription", "Sub Loan ID", "Surname",
    "Transaction category", "Transaction description",
))


# Columns that join with one another, by what they identify.
KEY_DOMAINS: dict[str, tuple[tuple[str, str], ...]] = {
    "case": tuple((table, "CaseID") for table, columns in COLUMNS.items() if "CaseID" in columns),
    "index": (("Rate_TBL", "IndexID"), ("Index_TBL", "IndexID")),
    "payment frequency": (("Loan_TBL", "PaymentFrequencyID"), ("PaymentFrequency", "Id")),
    "secondary status": (
        ("StatusSecondary", "StatusSecondaryTypeID"), ("StatusSecondaryType", "StatusSecondaryTypeID"),
    ),
    "security": (("CaseSecurity", "SecurityID"), ("SecurityStatusHistory", "SecurityID")),
    "status": (("StatusHistory_TBL", "StatusID"), ("Status_TBL", "StatusID")),
    "transaction type": (
        ("Transaction_TBL", "TransactionTypeId"), ("TransactionType_TBL", "TransactionTypeID"),
    ),
}


def _agreed(kinds: list[DataType]) -> DataType | None:
    """The type in which keys of such types are compared; None if there is none."""
    known = [k for k in kinds if not isinstance(k, NullType)]
    if len(set(known)) <= 1:
        return known[0] if known else StringType()
    whole = [isinstance(k, IntegralType) or (isinstance(k, DecimalType) and k.scale == 0) for k in known]
    if not all(w or isinstance(k, StringType) for w, k in zip(whole, known)):
        return None
    if any(isinstance(k, DecimalType) for k in known):
        return DecimalType(38, 0)
    return LongType() if any(whole) else StringType()


def _checked(table: str, name: str, kind: DataType, wanted: DataType) -> Column:
    """The key in the agreed type; running it fails at a text that is no whole number."""
    column = F.col(f"`{name}`")
    if kind == wanted:
        return column
    value = column.try_cast(wanted)
    if isinstance(kind, StringType):
        message = F.concat(F.lit(f"{table}.{name} holds no whole number: "), column)
        value = raise_if(column.isNotNull() & value.isNull(), message, value)
    return value.alias(name)


def agree_keys(tables: Mapping[str, DataFrame]) -> tuple[dict[str, DataFrame], list[str]]:
    """The tables with one type per kind of key, and what can't be agreed on, in words.

    Whole numbers of several widths meet in the widest, texts beside whole numbers become whole numbers.
    """
    changes: dict[str, dict[str, Column]] = {}
    wrong = []
    for domain, members in KEY_DOMAINS.items():
        there = [(t, c) for t, c in members if t in tables and c in tables[t].columns]
        kinds = [tables[t].schema[c].dataType for t, c in there]
        wanted = _agreed(kinds)
        if wanted is None:
            found = ", ".join(f"{t}.{c} is {k.simpleString()}" for (t, c), k in zip(there, kinds))
            wrong.append(f"the keys of one {domain} have types that can't be compared: {found}")
            continue
        for (t, c), kind in zip(there, kinds):
            if kind != wanted:
                changes.setdefault(t, {})[c] = _checked(t, c, kind, wanted)
    return {t: df.withColumns(changes[t]) if t in changes else df for t, df in tables.items()}, wrong


def _typed(name: str, kind: DataType) -> Column | str:
    """The column as its rules want it, or what type is wanted instead."""
    column = F.col(f"`{name}`")
    if name in DATES:
        fine = isinstance(kind, (DateType, TimestampType, TimestampNTZType, NullType))
        return column if fine else "a date or timestamp"
    if name in NUMBERS:
        return column if isinstance(kind, (NumericType, NullType)) else "a number"
    if name in FLAGS:
        return column if isinstance(kind, (NumericType, BooleanType, NullType)) else "a number or boolean"
    if name in TEXTS:
        if isinstance(kind, IntegralType):
            return column.cast("string").alias(name)
        return column if isinstance(kind, (StringType, NullType)) else "a text"
    nested = (ArrayType, MapType, StructType, BinaryType)
    return "a plain value" if isinstance(kind, nested) else column


def require_columns(df: DataFrame, columns: Iterable[str], table: str) -> DataFrame:
    """``df`` itself, or an error that names the missing columns. Case does not matter."""
    have = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    if missing:
        raise ValueError(f"table {table!r} lacks columns {missing}; it has {df.columns}")
    return df


def require_contract(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Check that all read tables are there with usable types, and reduce each to its read columns.

    Whole numbers in text columns become text, and keys that join get one type (:func:`agree_keys`). All other types
    that a rule can't use are named in one error.
    """
    absent = sorted(set(COLUMNS) - set(tables))
    if absent:
        raise ValueError(f"missing tables: {absent}")
    out, wrong = {}, []
    for name, columns in COLUMNS.items():
        df = require_columns(tables[name], columns, name)
        kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
        typed = {c: _typed(c, kinds[c.lower()]) for c in columns}
        for c, found in typed.items():
            if isinstance(found, str):
                wrong.append(f"{name}.{c} is {kinds[c.lower()].simpleString()}, wanted is {found}")
        out[name] = df.select(*[v.alias(c) for c, v in typed.items() if not isinstance(v, str)])
    out, unlike = agree_keys(out) if not wrong else (out, [])
    if wrong or unlike:
        raise TypeError("; ".join([*wrong, *unlike]))
    return out
