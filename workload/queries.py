"""The registered queries: each reads whole test tables, or the loan book derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from acctmart import (
    any_per_key,
    attach,
    attach_dimension,
    attach_fan_out,
    attach_spread,
    build_extract,
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
from acctmart.functions import (
    account_number,
    after_last,
    before_first,
    clamp_min,
    concat_blank,
    days_since,
    fixed2,
    flag_yn,
    fold,
    int_text,
    iso_date,
    month_boundaries,
    month_start,
    next_due_date,
    or_default,
    percent_text,
    recode_prefix,
    split_reference,
    text_length,
)
from acctmart.operators import newest_as_of, over_dates
from acctmart.plans import rules
from acctmart.plans.extract import HISTORY_MONTHS, TIE_BREAKS
from acctmart.sources import COLUMNS, load_tables, require_contract
from workload.loan_book import book_table, loan_book

AS_OF = "2000-01-31"
AS_OF_SHORT = "2000-02-15"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    """Register a query under its function name (less ``_query``), with plain result types."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn(spark, sf_dir))

    QUERIES[fn.__name__.removesuffix("_query")] = run
    return run


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, decimals as double, days as text: equal in any engine."""
    to = {"int": "bigint", "date": "string"}
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.select(
        *[
            F.col(f"`{c}`").cast("double" if k.startswith("decimal") else to.get(k, k)).alias(c)
            for c, k in kinds.items()
        ]
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_tables(spark, sf_dir, [name])[name]




# --- newest or declared row per key ---------------------------------------------------


@query
def latest_order_per_customer(spark, sf):
    orders = table(spark, sf, "orders")
    newest = latest_per_key(orders, "o_custkey", "o_orderdate", tie_break="-o_orderkey")
    return newest.select(
        "o_custkey",
        "o_orderkey",
        iso_date("o_orderdate").alias("order_day"),
        "o_totalprice",
        "o_orderstatus",
    )


@query
def latest_filtered_order(spark, sf):
    finished = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    newest = latest_per_key(finished, "o_custkey", "o_orderdate", tie_break="-o_orderkey")
    return newest.select("o_custkey", "o_orderkey", iso_date("o_orderdate").alias("order_day"))


@query
def any_order_per_customer(spark, sf):
    picked = any_per_key(table(spark, sf, "orders"), "o_custkey", tie_break="o_orderkey")
    return picked.select("o_custkey", "o_orderkey", "o_orderpriority")


@query
def latest_grade(spark, sf):
    return top1_lookup(
        table(spark, sf, "events"),
        key="user_id",
        order_by="ts",
        tie_break="event_type",
        values=[F.col("event_type").alias("grade")],
    )


# --- joins ---------------------------------------------------------------------------


@query
def customer_latest_order_wide(spark, sf):
    newest = latest_per_key(
        table(spark, sf, "orders"), "o_custkey", "o_orderdate", tie_break="-o_orderkey"
    ).select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice", "o_orderstatus"
    )
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    customers = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    )
    customers = attach_dimension(customers, nation, "c_nationkey")
    customers = attach_dimension(customers, region, "n_regionkey")
    return attach(customers, newest, "c_custkey").select(
        "c_custkey", "c_name", "c_mktsegment", "n_name", "r_name",
        "o_orderkey", "o_totalprice", "o_orderstatus",
    )


@query
def order_line_inner(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), "o_custkey", "o_orderpriority"
    )
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_discount").cast("decimal(9,6)").alias("discount"),
    )
    joined = attach(orders, lines, "order_id", "inner")
    return joined.select(
        "order_id",
        F.col("o_custkey").alias("customer_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("price").alias("amount"),
        F.col("price").alias("amount_due"),
        (F.col("price") - F.lit(100)).alias("net_amount"),
        (F.col("discount") * 100).alias("discount_percent"),
        F.lit("IE").alias("country"),
        F.lit(365).alias("day_count"),
        F.lit(None).cast("string").alias("reserved"),
    )


@query
def order_line_outer(spark, sf):
    """All orders with their lines of quantity above 40, one row per line."""
    lines = table(spark, sf, "lineitem").where(F.col("l_quantity") > 40)
    return attach_fan_out(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey"),
        lines.select(
            F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_linenumber", "l_quantity"
        ),
        "o_orderkey",
    )


@query
def reference_join(spark, sf):
    loan, sub = split_reference("Original Reference")
    cases = book_table(spark, sf, "Case_TBL").select(
        "CaseID",
        F.col("Original Reference").alias("reference"),
        loan.alias("Loan ID"),
        sub.alias("Sub Loan ID"),
    )
    joined = attach_spread(
        cases, book_table(spark, sf, "Loan Details"), ["Loan ID", "Sub Loan ID"]
    )
    return joined.select(
        "CaseID",
        "reference",
        F.col("Loan ID").alias("loan_id"),
        F.col("Sub Loan ID").alias("sub_loan_id"),
        iso_date("Origination Date").alias("origination_day"),
    )


@query
def recoded_key_join(spark, sf):
    applicants = any_per_key(
        book_table(spark, sf, "Applicant_TBL"), "CaseID", tie_break="BorrowerID"
    )
    customers = book_table(spark, sf, "Customer Details").withColumn(
        "BorrowerID", recode_prefix("Customer ID", rules.CUSTOMER_PREFIXES)
    )
    customers = any_per_key(customers, "BorrowerID", tie_break="Borrower Residency")
    return attach_spread(
        applicants.select("CaseID", "BorrowerID"), customers, "BorrowerID"
    ).select(
        F.col("CaseID").alias("case_id"),
        F.col("BorrowerID").alias("borrower_id"),
        F.col("Customer ID").alias("customer_id"),
        F.col("Borrower Residency").alias("residency"),
    )


@query
def rate_with_index(spark, sf):
    """Case to rate to index: a raw left join, then a code table by a chained key."""
    cases = book_table(spark, sf, "Case_TBL").select("CaseID")
    rates = attach_dimension(
        book_table(spark, sf, "Rate_TBL"), book_table(spark, sf, "Index_TBL"), "IndexID"
    )
    return attach(cases, rates, "CaseID", expect_unique=True).select(
        F.col("CaseID").alias("case_id"),
        F.col("IndexID").alias("index_id"),
        F.col("Index name").alias("funding"),
        percent_text("Index rate").alias("base_rate"),
        rules.rate_kind(F.col("ProductType")).alias("fix_floating"),
        iso_date("Period 1 end").alias("fixed_until"),
    )


@query
def lookup_and_simple_case(spark, sf):
    named = lookup_name(
        table(spark, sf, "customer"),
        table(spark, sf, "nation"),
        on="c_nationkey",
        dim_id="n_nationkey",
        dim_name="n_name",
        name="nation",
    )
    nation = F.col("nation")
    home = F.when(nation == "IRAN", "Y").when(nation == "FRANCE", "Y").otherwise("M")
    return named.select(
        "c_custkey", nation, nation.alias("billing_nation"), home.alias("unit")
    )


# --- aggregates per key --------------------------------------------------------------


@query
def first_last_ship_dates(spark, sf):
    dates = first_last_dates(
        table(spark, sf, "lineitem").select(
            F.col("l_orderkey").alias("o_orderkey"),
            "l_returnflag",
            F.to_date("l_shipdate").alias("ship_day"),
        ),
        "o_orderkey",
        "l_returnflag",
        "ship_day",
        {
            "first_returned": ("min", ("R",)),
            "last_returned": ("max", ("R",)),
            "first_kept": ("min", ("A", "N")),
            "last_kept": ("max", ("A", "N")),
        },
    )
    return attach(table(spark, sf, "orders").select("o_orderkey"), dates, "o_orderkey")


@query
def returnflags_text(spark, sf):
    lines = table(spark, sf, "lineitem")
    texts = {"lines": ("l_linenumber", ","), "flags": ("l_returnflag", ",")}
    return join_texts(lines, "l_orderkey", texts, order_by="l_linenumber")


@query
def supplier_names_text(spark, sf):
    """Names of the suppliers of an order's lines with quantity above 25; NULL if none."""
    lines = table(spark, sf, "lineitem").where(F.col("l_quantity") > 25)
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey"
    )
    names = join_text(
        attach_dimension(lines.select("l_orderkey", "l_suppkey"), suppliers, "l_suppkey").select(
            F.col("l_orderkey").alias("o_orderkey"), "s_name", "s_nationkey"
        ),
        "o_orderkey",
        F.concat("s_name", F.lit(" "), F.col("s_nationkey").cast("string")),
        "suppliers",
        ", ",
    )
    return attach(table(spark, sf, "orders").select("o_orderkey"), names, "o_orderkey")


@query
def related_count(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return count_related(
        table(spark, sf, "orders").select("o_orderkey"),
        lines,
        "o_orderkey",
        "returned_lines",
        F.col("l_returnflag") == "R",
    )


@query
def returned_flag(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    marked = has_related(
        table(spark, sf, "orders").select("o_orderkey"),
        lines,
        "o_orderkey",
        "returned",
        F.col("l_returnflag") == "R",
    )
    return marked.select(
        "o_orderkey",
        flag_yn(F.col("returned")).alias("returned_ind"),
        flag_yn(~F.col("returned")).alias("kept_ind"),
    )


@query
def open_latest_line_flag(spark, sf):
    links = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("order_id")
    )
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "order_id")
    counts = latest_status_count(
        links,
        lines,
        key="c_custkey",
        entity="order_id",
        order_by="l_shipdate",
        tie_break=["-l_linenumber", "l_linestatus"],
        where=F.col("l_linestatus") != "F",
        name="open_orders",
    )
    return attach(table(spark, sf, "customer").select("c_custkey"), counts, "c_custkey").select(
        "c_custkey",
        or_default("open_orders", 0).alias("open_orders"),
        flag_yn(F.col("open_orders") > 0).alias("open_ind"),
    )


@query
def month_offset_pivot_query(spark, sf):
    """Order totals per customer and month, 3 to 12 months before the as-of date."""
    monthly = (
        table(spark, sf, "orders")
        .groupBy("o_custkey", F.last_day(F.to_date("o_orderdate")).alias("month_end"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
    )
    return month_offset_pivot(
        monthly, "o_custkey", "month_end", "total", AS_OF, HISTORY_MONTHS, "total_"
    )


@query
def month_offset_pivot_largest(spark, sf):
    """Largest line per order in single months, where several rows share a month."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_shipdate", F.col("l_extendedprice").cast("decimal(18,2)").alias("price")
    )
    return month_offset_pivot(
        lines, "l_orderkey", "l_shipdate", "price", AS_OF, (0, 1, 6), "price_", on_duplicate="max"
    )


# --- newest-value lookups ------------------------------------------------------------


@query
def last_payment_lookup(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        "l_partkey",
        F.to_date("l_shipdate").alias("ship_day"),
        F.col("l_returnflag"),
    )
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return top1_lookup(
        lines,
        dim=parts,
        on="l_partkey",
        where=(F.col("l_returnflag") != "N") & (F.lower("p_type") != "standard anodized"),
        key="o_orderkey",
        order_by="ship_day",
        tie_break="p_type",
        values=[F.col("ship_day").alias("paid_on"), F.col("p_type").alias("paid_by")],
    )


def _payments(spark, sf):
    types = (
        book_table(spark, sf, "TransactionType_TBL")
        .where(F.lower("Transaction category") == rules.PAYMENT_CATEGORY)
        .withColumnRenamed("TransactionTypeID", "TransactionTypeId")
    )
    return top1_lookup(
        book_table(spark, sf, "Transaction_TBL"),
        dim=types,
        on="TransactionTypeId",
        where=F.col("Transaction amount") < 0,
        key="CaseID",
        order_by="Transaction date",
        tie_break="Transaction description",
        values=[
            F.col("Transaction date").alias("paid_on"),
            F.col("Transaction description").alias("paid_by"),
        ],
    )


@query
def payment_method(spark, sf):
    mandates = any_per_key(
        book_table(spark, sf, "DirectDebitInstructions"),
        "CaseID",
        tie_break=["IBAN", "BIC", "DDStatusID"],
    ).select("CaseID", "DDStatusID")
    cases = attach(book_table(spark, sf, "Case_TBL").select("CaseID"), mandates, "CaseID")
    return attach(cases, _payments(spark, sf), "CaseID").select(
        F.col("CaseID").alias("case_id"),
        iso_date("paid_on").alias("last_paid"),
        rules.payment_method(F.col("DDStatusID"), F.col("paid_by")).alias("payment_method"),
    )


@query
def direct_debit_details(spark, sf):
    active = book_table(spark, sf, "DirectDebitInstructions").where(
        F.col("DDStatusID") == rules.DD_ACTIVE
    )
    newest = latest_per_key(active, "CaseID", "NextCollection", tie_break=["IBAN", "BIC"])
    return newest.select(
        F.col("CaseID").alias("case_id"), "BIC", F.col("SortCode").alias("branch"), "IBAN"
    )


# --- column rules over whole tables --------------------------------------------------


@query
def account_number_query(spark, sf):
    cases = book_table(spark, sf, "Case_TBL")
    return cases.select(
        F.col("CaseID").alias("case_id"),
        account_number("AccountNumber", "CaseReference").alias("acc_no"),
    )


@query
def text_rules(spark, sf):
    customers = table(spark, sf, "customer")
    padded = F.concat("c_mktsegment", F.lit("  "))
    return customers.select(
        "c_custkey",
        text_length(padded).alias("segment_length"),
        fold(padded).alias("segment_key"),
        concat_blank("c_name", F.lit(None), F.lit("/"), "c_nationkey").alias("label"),
        F.concat("c_name", F.when(F.col("c_nationkey") > 4, "!")).alias("label_or_null"),
        before_first("c_name", "#").alias("name_head"),
        after_last("c_name", "#").alias("name_tail"),
        recode_prefix("c_mktsegment", {"A_T%": "1", "BUILD%": "2"}, skip=3).alias("recoded"),
    )


@query
def next_due_dates(spark, sf):
    orders = table(spark, sf, "orders")
    day = F.when(F.col("o_orderkey") % 37 == 0, None).otherwise(
        (F.col("o_orderkey") % 31 + 1).cast("int")
    )
    return orders.select("o_orderkey", day.alias("day")).select(
        "o_orderkey",
        F.col("day").cast("string").alias("day_text"),
        iso_date(next_due_date("day", AS_OF)).alias("due_long_month"),
        iso_date(next_due_date("day", AS_OF_SHORT)).alias("due_short_month"),
        iso_date(month_start(AS_OF, 1)).alias("next_charge"),
    )


@query
def arrears_days_term_months(spark, sf):
    info = book_table(spark, sf, "CaseInformation").select(
        "CaseID", "DateFirstInArrears", "MaturityDate"
    )
    loans = book_table(spark, sf, "Loan_TBL").select("CaseID", "Completion Date")
    terms = book_table(spark, sf, "DV_LoanTermRemaining")
    return attach(attach(loans, info, "CaseID"), terms, "CaseID").select(
        F.col("CaseID").alias("case_id"),
        days_since("DateFirstInArrears", AS_OF).alias("days_in_arrears"),
        iso_date("DateFirstInArrears").alias("arrears_day"),
        month_boundaries("Completion Date", "MaturityDate").alias("term_months"),
        clamp_min("Remaining term").alias("remaining_term"),
    )


@query
def rates_text(spark, sf):
    lines = table(spark, sf, "lineitem")
    cases = book_table(spark, sf, "Case_TBL").select("CaseID", "SectorCode")
    rates = book_table(spark, sf, "CaseInformation").select("CaseID", "CurBal", "PayRateNow")
    prices = lines.groupBy(F.col("l_orderkey").alias("CaseID")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price")
    )
    # rates of ten decimals, and binary ones
    fine = (F.col("CaseID") % 99991).cast("decimal(10,0)") * F.lit("0.0000023449").cast("decimal(10,10)")
    return attach(attach(cases, rates, "CaseID"), prices, "CaseID").select(
        F.col("CaseID").alias("case_id"),
        percent_text("PayRateNow").alias("rate"),
        fixed2(F.col("price") / F.lit(8).cast("decimal(4,0)")).alias("eighth"),
        fixed2(F.col("CurBal") - F.col("price")).alias("difference"),
        int_text("SectorCode").alias("sector"),
        percent_text(fine).alias("fine_rate"),
        percent_text(F.col("CaseID") % 1000 / F.lit(8192.0)).alias("binary_rate"),
    )


@query
def defaults_and_flags(spark, sf):
    loans = book_table(spark, sf, "Loan_TBL")
    info = book_table(spark, sf, "CaseInformation").select(
        "CaseID", "OutstandingArrears", "CurBal", "ArrearsLME", "MaturityDate"
    )
    rates = book_table(spark, sf, "Rate_TBL").select("CaseID", "Period 1 end")
    joined = attach(attach(loans, info, "CaseID"), rates, "CaseID")
    return joined.select(
        F.col("CaseID").alias("case_id"),
        or_default("Originator", rules.DEFAULT_ORIGINATOR).alias("origination_entity"),
        iso_date(or_default("Period 1 end", F.col("MaturityDate"))).alias("reset_day"),
        flag_yn(F.col("OutstandingArrears") > 0).alias("arrears_ind"),
        (F.col("CurBal") - F.col("ArrearsLME")).alias("net_limit"),
        flag_yn(F.col("FirstTimeBuyer") == 1).alias("first_time_buyer_ind"),
        flag_yn(rules.is_interest_only(F.col("Repayment method"))).alias("interest_only_ind"),
        F.col("CreditGradeOverride").alias("override_grade"),
        F.col("Currency").alias("currency"),
    )


# --- business rules ------------------------------------------------------------------


@query
def account_status(spark, sf):
    newest = latest_per_key(
        book_table(spark, sf, "StatusHistory_TBL"),
        "CaseID",
        "Datechanged",
        tie_break=["-Effective date", "-StatusID"],
    )
    named = attach_dimension(newest, book_table(spark, sf, "Status_TBL"), "StatusID")
    return named.select(
        F.col("CaseID").alias("case_id"),
        F.col("Status").alias("status"),
        rules.close_date(F.col("Status"), F.col("Effective date")).alias("close_day"),
    )


@query
def litigation_dates(spark, sf):
    return first_last_dates(
        book_table(spark, sf, "StatusSecondary"),
        "CaseID",
        "StatusSecondaryTypeID",
        "EffectiveDate",
        rules.LITIGATION_DATES,
    )


@query
def legal_status(spark, sf):
    newest = latest_per_key(
        book_table(spark, sf, "StatusSecondary"),
        "CaseID",
        "ChangedOnDate",
        tie_break="-StatusSecondaryTypeID",
    ).select("CaseID", "StatusSecondaryTypeID")
    named = attach_dimension(
        newest, book_table(spark, sf, "StatusSecondaryType"), "StatusSecondaryTypeID"
    )
    return named.select(
        F.col("CaseID").alias("case_id"),
        rules.legal_description(
            F.col("StatusSecondaryTypeID"), F.col("StatusDescription")
        ).alias("legal_status"),
    )


@query
def interest_only_end(spark, sf):
    loans = book_table(spark, sf, "Loan_TBL").select("CaseID", "Repayment method")
    info = book_table(spark, sf, "CaseInformation").select("CaseID", "MaturityDate")
    rates = attach_dimension(
        book_table(spark, sf, "Rate_TBL"), book_table(spark, sf, "Index_TBL"), "IndexID"
    ).select("CaseID", "Period 1 end", "ProductType")
    ara = latest_per_key(
        book_table(spark, sf, "AraHistory"),
        "CaseID",
        "EffectiveDate",
        tie_break=["-DSTResolutionOptionID", "-ProjectedEndDate"],
    ).select("CaseID", "DSTResolutionOptionID", "ProjectedEndDate")
    joined = attach(attach(attach(loans, info, "CaseID"), rates, "CaseID"), ara, "CaseID")
    return joined.select(
        F.col("CaseID").alias("case_id"),
        rules.arranged_end(
            F.col("DSTResolutionOptionID"),
            iso_date("ProjectedEndDate"),
            rules.interest_only_end(
                F.col("ProductType"),
                F.col("Repayment method"),
                F.col("Period 1 end"),
                F.col("MaturityDate"),
            ),
        ).alias("interest_only_until"),
        rules.rate_kind(F.col("ProductType")).alias("fix_floating"),
    )


def _newest_marp(spark, sf):
    return latest_per_key(
        book_table(spark, sf, "MarpTypeHistory"), "CaseID", "ChangedOnDate",
        tie_break="-MarpTypeID",
    )


@query
def marp_flag(spark, sf):
    cases = book_table(spark, sf, "Case_TBL").select("CaseID", "RegulatoryBodyId")
    loans = book_table(spark, sf, "Loan_TBL").select("CaseID", "Purpose")
    balances = latest_per_key(
        book_table(spark, sf, "MonthlyBalances_TBL"), "CaseID", "Date", tie_break="-Arrears"
    ).select("CaseID", "Arrears")
    joined = attach(cases, loans, "CaseID", "inner")
    joined = attach(attach(joined, _newest_marp(spark, sf), "CaseID"), balances, "CaseID")
    marp = F.col("MarpTypeID")
    return joined.select(
        F.col("CaseID").alias("case_id"),
        rules.marp_flag(
            marp, F.col("RegulatoryBodyId"), F.col("Purpose"), F.col("Arrears")
        ).alias("marp_flag"),
        rules.marp_ind(marp).alias("marp_ind"),
        rules.pre_arrears(marp).alias("pre_arrears"),
    )


@query
def marp_date(spark, sf):
    return _newest_marp(spark, sf).select(
        F.col("CaseID").alias("case_id"),
        rules.marp_date(F.col("MarpTypeID"), F.col("ChangedOnDate")).alias("marp_day"),
    )


@query
def secured_flag(spark, sf):
    counts = latest_status_count(
        book_table(spark, sf, "CaseSecurity"),
        book_table(spark, sf, "SecurityStatusHistory"),
        key="CaseID",
        entity="SecurityID",
        order_by="EffectiveDate",
        tie_break="-StatusID",
        where=F.col("StatusID") != rules.SECURITY_RELEASED,
        name="securities",
    )
    cases = book_table(spark, sf, "Case_TBL").select("CaseID")
    return attach(cases, counts, "CaseID").select(
        F.col("CaseID").alias("case_id"),
        or_default("securities", 0).alias("securities"),
        flag_yn(F.col("securities") > 0).alias("secured_ind"),
    )


@query
def guarantor_and_notices(spark, sf):
    cases = book_table(spark, sf, "Case_TBL").select("CaseID")
    marked = has_related(
        cases, book_table(spark, sf, "Facilitator"), "CaseID", "guarantor",
        F.col("FacilitatorTypeID") == rules.GUARANTOR_TYPE,
    )
    marked = has_related(
        marked, book_table(spark, sf, "Applicant_TBL"), "CaseID", "withhold",
        F.col("WithholdCommunication") == 1,
    )
    return marked.select(
        F.col("CaseID").alias("case_id"),
        flag_yn(F.col("guarantor")).alias("guarantor_ind"),
        flag_yn(F.col("withhold")).alias("stop_notices"),
    )


@query
def applicant_names(spark, sf):
    names = join_text(
        book_table(spark, sf, "Applicant_TBL"),
        "CaseID",
        F.concat("First name", F.lit(" "), "Surname"),
        "acc_name",
        ", ",
    )
    return attach(book_table(spark, sf, "Case_TBL").select("CaseID"), names, "CaseID")


@query
def payment_history(spark, sf):
    return month_offset_pivot(
        book_table(spark, sf, "ReceivedDue_TBL"),
        "CaseID", "Month end", "Payments received", AS_OF, HISTORY_MONTHS, "paid_",
    )


# --- inputs and the whole extract ----------------------------------------------------


@query
def loan_book_inputs(spark, sf):
    """Rows of every input table after the contract check."""
    tables = loan_book(spark, sf)
    read = {**tables, **require_contract(tables)}
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            F.lit(len(COLUMNS.get(name, ()))).alias("n_columns_read"),
            "n_rows",
        )
        for name, df in read.items()
    ]
    out = counts[0]
    for one in counts[1:]:
        out = out.union(one)
    return out


@query
def account_extract(spark, sf):
    return build_extract(loan_book(spark, sf), AS_OF)


def rates_per_line(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("CaseID"),
        (F.col("l_linenumber") % 6).cast("int").alias("IndexID"),
        F.to_date("l_shipdate").alias("Period 1 end"),
    )


@query
def account_extract_repeated_cases(spark, sf):
    """The extract where cases have one rate row per line of their order."""
    return build_extract({**loan_book(spark, sf), "Rate_TBL": rates_per_line(spark, sf)}, AS_OF)


@query
def account_extract_spread(spark, sf):
    """The same by the joins for cases with very many rows."""
    return build_extract({**loan_book(spark, sf), "Rate_TBL": rates_per_line(spark, sf)}, AS_OF, repeated_cases=True)


@query
def account_extract_char_bit(spark, sf):
    """The extract from blank-padded and upper-cased texts and boolean flags, as other readers give them."""
    t = loan_book(spark, sf)

    def padded(name: str, column: str, upper: bool = False) -> None:
        text = F.upper(F.col(column)) if upper else F.col(column)
        t[name] = t[name].withColumn(column, F.rpad(text, 40, " "))

    for name, column in (
        ("Index_TBL", "ProductType"),
        ("Loan_TBL", "Repayment method"),
        ("Loan_TBL", "Purpose"),
        ("TransactionType_TBL", "Transaction category"),
        ("Customer Details", "Customer ID"),
        ("Loan Details", "Loan ID"),
    ):
        padded(name, column, upper=True)
    # these show up in the result, so their case stays
    padded("Status_TBL", "Status")
    padded("PaymentFrequency", "Name")
    padded("TransactionType_TBL", "Transaction description")
    for name, column in (("Loan_TBL", "FirstTimeBuyer"), ("Applicant_TBL", "WithholdCommunication")):
        t[name] = t[name].withColumn(column, F.col(column).cast("boolean"))
    shown = ("ACC_STA_CDE", "INT_PMT_FREQ_CDE", "TOT_INSTALMT_PMT_FREQ_CDE", "PAYMENT_METHOD")
    return build_extract(t, AS_OF, ci=True).withColumns({c: F.rtrim(c) for c in shown})


@query
def account_extract_mid_month(spark, sf):
    return build_extract(loan_book(spark, sf), AS_OF_SHORT)


@query
def unique_outer_join(spark, sf):
    """A full join with a right side checked to be unique, where a third of the right keys is unknown."""
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), "s_name")
    customers = table(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")).alias("k"), "c_name"
    )
    return attach(suppliers, customers, "k", "full", expect_unique=True)


STATE_DATES = ("1997-03-31", "1998-09-15", "2000-01-31")


@query
def account_state_over_dates(spark, sf):
    """Balance, instalment, status, MARP type and grade of every case with a loan at three dates, in one run."""
    t = loan_book(spark, sf)

    def at(name, order_by, values):
        return newest_as_of(
            t[name], "CaseID", order_by, STATE_DATES, tie_break=TIE_BREAKS[name], values=values
        )

    status = attach_dimension(
        at("StatusHistory_TBL", "Datechanged", {"StatusID": "StatusID"}), t["Status_TBL"], "StatusID"
    )
    states = over_dates(t["Loan_TBL"].select("CaseID").distinct(), STATE_DATES)
    for side in (
        at("MonthlyBalances_TBL", "Date", {"month_arrears": "Arrears", "balance_day": "Date"}),
        at("CMSHistory_TBL", "CMS Month", {"instalment": "CMS"}),
        status.select("CaseID", "as_of", F.col("Status").alias("status")),
        at("MarpTypeHistory", "ChangedOnDate", {"marp_type": "MarpTypeID"}),
        at("CreditGrade", "DateOfChange", {"grade": "Grade"}),
    ):
        states = attach(states, side, ["CaseID", "as_of"])
    return states.select(
        F.col("CaseID").alias("case_id"),
        F.col("as_of").cast("string").alias("as_of"),
        F.col("month_arrears").cast("double").alias("month_arrears"),
        F.col("balance_day").cast("string").alias("balance_day"),
        F.col("instalment").cast("double").alias("instalment"),
        "status",
        "marp_type",
        "grade",
    )


@query
def account_extract_point_in_time(spark, sf):
    """The extract as of an earlier date, with nothing that came later."""
    return build_extract(loan_book(spark, sf), STATE_DATES[1], point_in_time=True)
