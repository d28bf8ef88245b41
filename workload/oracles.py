"""SQL checks for the registered queries, written for a plain SQL engine on the same tables.

They share only the derivation of the loan book with the Spark side. Whole
numbers are BIGINT, money DOUBLE and days ISO text, as in ``queries.plain``.
"""

from __future__ import annotations

from workload.loan_book import BOOK, book_cte

AS_OF = "DATE '2000-01-31'"
AS_OF_SHORT = "DATE '2000-02-15'"

ORACLES: dict[str, str] = {}


# Histories and their days.
DAYS = {
    "AraHistory": "EffectiveDate", "CMSHistory_TBL": "CMS Month", "CreditGrade": "DateOfChange",
    "MarpTypeHistory": "ChangedOnDate", "MonthlyBalances_TBL": "Date", "SecurityStatusHistory": "EffectiveDate",
    "StatusHistory_TBL": "Datechanged", "StatusSecondary": "ChangedOnDate", "Transaction_TBL": "Transaction date",
}


def over_book(*names: str, until: str | None = None) -> str:
    """The loan book's tables; with ``until``, histories without later rows."""
    parts = []
    for name in names:
        made = book_cte(name)
        if until and name in DAYS:
            head, day = f'"{name}" AS (', DAYS[name]
            body = made[len(head) : -1]
            made = f'{head}SELECT * FROM ({body}) WHERE "{day}" IS NULL OR CAST("{day}" AS DATE) <= {until})'
        parts.append(made)
    return "WITH " + ",\n".join(parts)


def due(day: str, as_of: str) -> str:
    """Next date with this day of month, at the latest the last of the due month."""
    month = (
        f"CAST(date_trunc('month', {as_of}) + CASE WHEN day({as_of}) > {day} "
        "THEN INTERVAL 1 MONTH ELSE INTERVAL 0 MONTH END AS DATE)"
    )
    return (
        f"CASE WHEN {day} IS NOT NULL THEN "
        f"CAST(least({month} + CAST({day} - 1 AS INT), last_day({month})) AS VARCHAR) END"
    )


def months_between(a: str, b: str) -> str:
    return f"CAST(datediff('month', {a}, {b}) AS BIGINT)"


def percent(rate: str, decimals: int = 6) -> str:
    exact = f"CAST({rate} * 100 AS DECIMAL(28,{decimals}))"
    return f"format('{{:,.2f}}', CAST(round({exact}, 2) AS DOUBLE))"


def month_columns(value: str, date: str, offsets, prefix: str, agg: str = "max") -> str:
    return ",\n".join(
        f"CAST({agg}({value}) FILTER (WHERE datediff('month', CAST({date} AS DATE), {AS_OF}) = {k})"
        f" AS DOUBLE) AS {prefix}{k}"
        for k in offsets
    )


def code_list(codes) -> str:
    return ", ".join(str(c) for c in codes)


# --- newest or declared row per key ---------------------------------------------------

ORACLES["latest_order_per_customer"] = """
SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day,
       o_totalprice, o_orderstatus
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                   ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS n
      FROM orders)
WHERE n = 1
"""

ORACLES["latest_filtered_order"] = """
SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                   ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS n
      FROM orders WHERE o_orderstatus = 'F')
WHERE n = 1
"""

ORACLES["any_order_per_customer"] = """
SELECT o.o_custkey, o.o_orderkey, o.o_orderpriority
FROM orders o
JOIN (SELECT o_custkey, min(o_orderkey) AS k FROM orders GROUP BY o_custkey) f
  ON f.o_custkey = o.o_custkey AND f.k = o.o_orderkey
"""

ORACLES["latest_grade"] = """
SELECT e.user_id, min(e.event_type) AS grade
FROM events e
JOIN (SELECT user_id, max(ts) AS ts FROM events GROUP BY user_id) n
  ON n.user_id = e.user_id AND n.ts = e.ts
GROUP BY e.user_id
"""

# --- joins ---------------------------------------------------------------------------

ORACLES["customer_latest_order_wide"] = """
SELECT c.c_custkey, c.c_name, c.c_mktsegment, n.n_name, r.r_name,
       o.o_orderkey, o.o_totalprice, o.o_orderstatus
FROM customer c
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN (SELECT DISTINCT ON (o_custkey) * FROM orders
           ORDER BY o_custkey, o_orderdate DESC NULLS LAST, o_orderkey DESC) o
       ON o.o_custkey = c.c_custkey
"""

ORACLES["order_line_inner"] = """
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
       CAST(l.l_linenumber AS BIGINT) AS line, l.l_partkey AS part_id, l.l_suppkey AS supplier_id,
       CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
       CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS amount_due,
       CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) - 100 AS DOUBLE) AS net_amount,
       CAST(CAST(l.l_discount AS DECIMAL(9,6)) * 100 AS DOUBLE) AS discount_percent,
       'IE' AS country, CAST(365 AS BIGINT) AS day_count, CAST(NULL AS VARCHAR) AS reserved
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
"""

ORACLES["order_line_outer"] = """
SELECT o_orderkey, o_custkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_quantity > 40
"""

ORACLES["reference_join"] = over_book("Case_TBL", "Loan Details") + """
, parts AS (
  SELECT "CaseID", "Original Reference" AS reference,
         string_split("Original Reference", '-') AS p
  FROM "Case_TBL"
), keyed AS (
  SELECT "CaseID", reference,
         CASE WHEN len(p) > 1 THEN p[1] END AS loan_id,
         CASE WHEN len(p) > 1 THEN p[len(p)] END AS sub_loan_id
  FROM parts
)
SELECT k."CaseID", k.reference, k.loan_id, k.sub_loan_id,
       CAST(CAST(d."Origination Date" AS DATE) AS VARCHAR) AS origination_day
FROM keyed k
LEFT JOIN "Loan Details" d ON d."Loan ID" = k.loan_id AND d."Sub Loan ID" = k.sub_loan_id
"""

# the declared applicant is the first by id, unknown ids before all others
DECLARED = """
  SELECT DISTINCT ON ("CaseID") "CaseID", "BorrowerID" AS b FROM "Applicant_TBL"
  ORDER BY "CaseID", "BorrowerID" NULLS FIRST
"""

RECODED = """
  SELECT *, CASE substr("Customer ID", 1, 4)
              WHEN 'URI_' THEN concat('1', rtrim(substr("Customer ID", 5)))
              WHEN 'UFA_' THEN concat('2', rtrim(substr("Customer ID", 5)))
              ELSE "Customer ID" END AS id
  FROM "Customer Details"
"""

ORACLES["recoded_key_join"] = over_book("Applicant_TBL", "Customer Details") + f"""
, recoded AS ({RECODED})
SELECT a."CaseID" AS case_id, a.b AS borrower_id, c."Customer ID" AS customer_id,
       c."Borrower Residency" AS residency
FROM ({DECLARED}) a
LEFT JOIN (SELECT DISTINCT ON (id) * FROM recoded
           ORDER BY id, "Borrower Residency" NULLS FIRST) c ON c.id = a.b
"""

ORACLES["rate_with_index"] = over_book("Case_TBL", "Rate_TBL", "Index_TBL") + f"""
SELECT c."CaseID" AS case_id, CAST(r."IndexID" AS BIGINT) AS index_id, i."Index name" AS funding,
       {percent('i."Index rate"')} AS base_rate,
       CASE WHEN lower(i."ProductType") IN ('fixed', 'fixed (mars)', 'fixed (sco22)', 'staff')
            THEN 'F' ELSE 'V' END AS fix_floating,
       CAST(r."Period 1 end" AS VARCHAR) AS fixed_until
FROM "Case_TBL" c
LEFT JOIN "Rate_TBL" r ON r."CaseID" = c."CaseID"
LEFT JOIN "Index_TBL" i ON i."IndexID" = r."IndexID"
"""

ORACLES["lookup_and_simple_case"] = """
SELECT c_custkey,
       (SELECT n_name FROM nation WHERE n_nationkey = c_nationkey) AS nation,
       (SELECT n_name FROM nation WHERE n_nationkey = c_nationkey) AS billing_nation,
       CASE (SELECT n_name FROM nation WHERE n_nationkey = c_nationkey)
         WHEN 'IRAN' THEN 'Y' WHEN 'FRANCE' THEN 'Y' ELSE 'M' END AS unit
FROM customer
"""

# --- aggregates per key --------------------------------------------------------------

ORACLES["first_last_ship_dates"] = """
SELECT o.o_orderkey,
       CAST(min(CAST(l.l_shipdate AS DATE)) FILTER (WHERE l.l_returnflag = 'R') AS VARCHAR)
         AS first_returned,
       CAST(max(CAST(l.l_shipdate AS DATE)) FILTER (WHERE l.l_returnflag = 'R') AS VARCHAR)
         AS last_returned,
       CAST(min(CAST(l.l_shipdate AS DATE)) FILTER (WHERE l.l_returnflag IN ('A', 'N')) AS VARCHAR)
         AS first_kept,
       CAST(max(CAST(l.l_shipdate AS DATE)) FILTER (WHERE l.l_returnflag IN ('A', 'N')) AS VARCHAR)
         AS last_kept
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey
"""

ORACLES["returnflags_text"] = """
SELECT l_orderkey,
       string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS lines,
       string_agg(l_returnflag, ',' ORDER BY l_linenumber, l_returnflag) AS flags
FROM lineitem GROUP BY l_orderkey
"""

ORACLES["supplier_names_text"] = """
SELECT o.o_orderkey, t.suppliers
FROM orders o
LEFT JOIN (SELECT l_orderkey,
                  string_agg(s_name || ' ' || CAST(s_nationkey AS VARCHAR), ', '
                             ORDER BY s_name || ' ' || CAST(s_nationkey AS VARCHAR)) AS suppliers
           FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey
           WHERE l_quantity > 25
           GROUP BY l_orderkey) t ON t.l_orderkey = o.o_orderkey
"""

ORACLES["related_count"] = """
SELECT o_orderkey,
       (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
         AS returned_lines
FROM orders
"""

ORACLES["returned_flag"] = """
SELECT o_orderkey,
       CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey
                         AND l_returnflag = 'R') THEN 'Y' ELSE 'N' END AS returned_ind,
       CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey
                         AND l_returnflag = 'R') THEN 'N' ELSE 'Y' END AS kept_ind
FROM orders
"""

ORACLES["open_latest_line_flag"] = """
WITH newest AS (
  SELECT DISTINCT ON (l_orderkey) l_orderkey, l_linestatus FROM lineitem
  ORDER BY l_orderkey, l_shipdate DESC NULLS LAST, l_linenumber DESC, l_linestatus
), counts AS (
  SELECT o_custkey, count(*) AS n
  FROM orders JOIN newest ON l_orderkey = o_orderkey
  WHERE l_linestatus <> 'F' GROUP BY o_custkey
)
SELECT c_custkey, coalesce(n, 0) AS open_orders,
       CASE WHEN n > 0 THEN 'Y' ELSE 'N' END AS open_ind
FROM customer LEFT JOIN counts ON o_custkey = c_custkey
"""

ORACLES["month_offset_pivot"] = f"""
SELECT o_custkey,
       {month_columns("CAST(o_totalprice AS DECIMAL(18,2))", "o_orderdate", range(3, 13),
                      "total_", "sum")}
FROM orders
WHERE datediff('month', CAST(o_orderdate AS DATE), {AS_OF}) BETWEEN 3 AND 12
GROUP BY o_custkey
"""

ORACLES["month_offset_pivot_largest"] = f"""
SELECT l_orderkey,
       {month_columns("CAST(l_extendedprice AS DECIMAL(18,2))", "l_shipdate", (0, 1, 6), "price_")}
FROM lineitem
WHERE datediff('month', CAST(l_shipdate AS DATE), {AS_OF}) IN (0, 1, 6)
GROUP BY l_orderkey
"""

# --- newest-value lookups ------------------------------------------------------------

ORACLES["last_payment_lookup"] = """
WITH paid AS (
  SELECT l_orderkey, CAST(l_shipdate AS DATE) AS d, p_type
  FROM lineitem JOIN part ON p_partkey = l_partkey
  WHERE l_returnflag <> 'N' AND lower(p_type) <> 'standard anodized'
), last AS (SELECT l_orderkey, max(d) AS d FROM paid GROUP BY l_orderkey)
SELECT p.l_orderkey AS o_orderkey, CAST(l.d AS VARCHAR) AS paid_on, min(p.p_type) AS paid_by
FROM paid p JOIN last l ON l.l_orderkey = p.l_orderkey AND l.d = p.d
GROUP BY p.l_orderkey, l.d
"""

PAYMENTS = """
  SELECT "CaseID", max("Transaction date") AS paid_on,
         arg_min(description, (-epoch("Transaction date"), description)) AS paid_by
  FROM (SELECT x."CaseID", x."Transaction date", y."Transaction description" AS description
        FROM "Transaction_TBL" x
        JOIN "TransactionType_TBL" y ON y."TransactionTypeID" = x."TransactionTypeId"
        WHERE lower(y."Transaction category") = 'pmt' AND x."Transaction amount" < 0)
  GROUP BY "CaseID"
"""

PAID_BY = """CASE WHEN any_dd.status = 2 THEN 'Direct Debit'
            WHEN pay.paid_by = 'Direct Debit Payment' THEN 'Direct Debit'
            ELSE pay.paid_by END"""

ANY_MANDATE = """
  SELECT DISTINCT ON ("CaseID") "CaseID", "DDStatusID" AS status
  FROM "DirectDebitInstructions" ORDER BY "CaseID", "IBAN", "BIC", "DDStatusID"
"""

ORACLES["payment_method"] = over_book(
    "Case_TBL", "DirectDebitInstructions", "Transaction_TBL", "TransactionType_TBL"
) + f"""
, pay AS ({PAYMENTS}), any_dd AS ({ANY_MANDATE})
SELECT c."CaseID" AS case_id, CAST(pay.paid_on AS VARCHAR) AS last_paid,
       {PAID_BY} AS payment_method
FROM "Case_TBL" c
LEFT JOIN any_dd ON any_dd."CaseID" = c."CaseID"
LEFT JOIN pay ON pay."CaseID" = c."CaseID"
"""

ACTIVE_MANDATE = """
  SELECT DISTINCT ON ("CaseID") * FROM "DirectDebitInstructions" WHERE "DDStatusID" = 2
  ORDER BY "CaseID", "NextCollection" DESC NULLS LAST, "IBAN", "BIC"
"""

ORACLES["direct_debit_details"] = over_book("DirectDebitInstructions") + f"""
SELECT "CaseID" AS case_id, "BIC", "SortCode" AS branch, "IBAN" FROM ({ACTIVE_MANDATE})
"""

# --- column rules over whole tables --------------------------------------------------

ACC_NO = """'000000' || coalesce(c."AccountNumber", '') || coalesce(lpad(
         substr(c."CaseReference", strpos(c."CaseReference", '-') + 1, 2), 2, '0'), '')"""

ORACLES["account_number"] = over_book("Case_TBL") + f"""
SELECT c."CaseID" AS case_id, {ACC_NO} AS acc_no FROM "Case_TBL" c
"""

ORACLES["text_rules"] = """
SELECT c_custkey,
       CAST(length(rtrim(c_mktsegment)) AS BIGINT) AS segment_length,
       lower(rtrim(c_mktsegment)) AS segment_key,
       c_name || '/' || CAST(c_nationkey AS VARCHAR) AS label,
       CASE WHEN c_nationkey > 4 THEN c_name || '!' END AS label_or_null,
       CASE WHEN contains(c_name, '#') THEN split_part(c_name, '#', 1) END AS name_head,
       CASE WHEN contains(c_name, '#') THEN split_part(c_name, '#', -1) END AS name_tail,
       CASE WHEN regexp_full_match(c_mktsegment, 'A.T.*') THEN '1' || substr(c_mktsegment, 4)
            WHEN starts_with(c_mktsegment, 'BUILD') THEN '2' || substr(c_mktsegment, 4)
            ELSE c_mktsegment END AS recoded
FROM customer
"""

ORACLES["next_due_dates"] = f"""
SELECT o_orderkey, CAST(d AS VARCHAR) AS day_text,
       {due("d", AS_OF)} AS due_long_month, {due("d", AS_OF_SHORT)} AS due_short_month,
       '2000-02-01' AS next_charge
FROM (SELECT o_orderkey,
             CASE WHEN o_orderkey % 37 <> 0 THEN CAST(o_orderkey % 31 + 1 AS INT) END AS d
      FROM orders)
"""

ORACLES["arrears_days_term_months"] = over_book(
    "Loan_TBL", "CaseInformation", "DV_LoanTermRemaining"
) + f"""
SELECT l."CaseID" AS case_id,
       CAST(coalesce({AS_OF} - i."DateFirstInArrears", 0) AS BIGINT) AS days_in_arrears,
       CAST(i."DateFirstInArrears" AS VARCHAR) AS arrears_day,
       {months_between('l."Completion Date"', 'i."MaturityDate"')} AS term_months,
       CASE WHEN t."Remaining term" IS NOT NULL
            THEN CAST(greatest(t."Remaining term", 0) AS BIGINT) END AS remaining_term
FROM "Loan_TBL" l
LEFT JOIN "CaseInformation" i ON i."CaseID" = l."CaseID"
LEFT JOIN "DV_LoanTermRemaining" t ON t."CaseID" = l."CaseID"
"""

FINE_RATE = """(CAST(c."CaseID" % 99991 AS DECIMAL(10,0)) * CAST(0.0000023449 AS DECIMAL(10,10)))"""
BINARY_RATE = """CAST(c."CaseID" % 1000 / 8192.0 AS DECIMAL(18,13))"""

ORACLES["rates_text"] = over_book("Case_TBL", "CaseInformation") + f"""
, prices AS (
  SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS price
  FROM lineitem GROUP BY l_orderkey
)
SELECT c."CaseID" AS case_id, {percent('i."PayRateNow"')} AS rate,
       format('{{:,.2f}}', CAST(round(CAST(p.price * 0.125 AS DECIMAL(28,5)), 2) AS DOUBLE))
         AS eighth,
       format('{{:,.2f}}', CAST(i."CurBal" - p.price AS DOUBLE)) AS difference,
       CAST(CAST(round(c."SectorCode", 0) AS BIGINT) AS VARCHAR) AS sector,
       {percent(FINE_RATE, 10)} AS fine_rate, {percent(BINARY_RATE, 13)} AS binary_rate
FROM "Case_TBL" c
LEFT JOIN "CaseInformation" i ON i."CaseID" = c."CaseID"
LEFT JOIN prices p ON p.l_orderkey = c."CaseID"
"""

ORACLES["defaults_and_flags"] = over_book("Loan_TBL", "CaseInformation", "Rate_TBL") + """
SELECT l."CaseID" AS case_id,
       CASE WHEN l."Originator" IS NULL THEN 'ULSTER BANK' ELSE l."Originator" END
         AS origination_entity,
       CAST(CASE WHEN r."Period 1 end" IS NULL THEN i."MaturityDate" ELSE r."Period 1 end" END
            AS VARCHAR) AS reset_day,
       CASE WHEN i."OutstandingArrears" > 0 THEN 'Y' ELSE 'N' END AS arrears_ind,
       CAST(i."CurBal" - i."ArrearsLME" AS DOUBLE) AS net_limit,
       CASE WHEN l."FirstTimeBuyer" = 1 THEN 'Y' ELSE 'N' END AS first_time_buyer_ind,
       CASE WHEN lower(l."Repayment method") = 'interest only' THEN 'Y' ELSE 'N' END
         AS interest_only_ind,
       l."CreditGradeOverride" AS override_grade, l."Currency" AS currency
FROM "Loan_TBL" l
LEFT JOIN "CaseInformation" i ON i."CaseID" = l."CaseID"
LEFT JOIN "Rate_TBL" r ON r."CaseID" = l."CaseID"
"""

# --- business rules ------------------------------------------------------------------

STATUS = """
  SELECT h."CaseID", s."Status" AS status,
         CASE WHEN lower(s."Status") = 'redeemed' THEN CAST(h."Effective date" AS VARCHAR) END AS close_day
  FROM (SELECT DISTINCT ON ("CaseID") * FROM "StatusHistory_TBL"
        ORDER BY "CaseID", "Datechanged" DESC NULLS LAST, "Effective date" DESC, "StatusID" DESC) h
  LEFT JOIN "Status_TBL" s ON s."StatusID" = h."StatusID"
"""

ORACLES["account_status"] = over_book("StatusHistory_TBL", "Status_TBL") + f"""
SELECT "CaseID" AS case_id, status, close_day FROM ({STATUS})
"""

# The status codes of each stage.
START = [17, 18, 19, 20, 21, 22, 23, 25, 27, 28, 29, 42, 43, 44, 45, 46, 47, 48, 49, 50, 51, 71]
END = [31, 32, 33, 34, 35, 36, 37, 38]
PRE_START = [9, 10, 11, 12, 13]

LITIGATION = f"""
  SELECT "CaseID",
    CAST(min("EffectiveDate") FILTER (WHERE "StatusSecondaryTypeID" IN ({code_list(START)}))
         AS VARCHAR) AS "LTGTN_START_DTE",
    CAST(max("EffectiveDate") FILTER (WHERE "StatusSecondaryTypeID" IN ({code_list(END)}))
         AS VARCHAR) AS "LTGTN_END_DTE",
    CAST(min("EffectiveDate") FILTER (WHERE "StatusSecondaryTypeID" IN ({code_list(PRE_START)}))
         AS VARCHAR) AS "PRE_LTGTN_START_DTE",
    CAST(max("EffectiveDate") FILTER (WHERE "StatusSecondaryTypeID" IN (42, 49))
         AS VARCHAR) AS "PRE_LTGTN_END_DTE"
  FROM "StatusSecondary" GROUP BY "CaseID"
"""

ORACLES["litigation_dates"] = over_book("StatusSecondary") + LITIGATION

LEGAL = f"""
  SELECT n."CaseID", d."StatusDescription" AS legal_status
  FROM (SELECT DISTINCT ON ("CaseID") "CaseID", "StatusSecondaryTypeID" AS code
        FROM "StatusSecondary"
        ORDER BY "CaseID", "ChangedOnDate" DESC NULLS LAST, "StatusSecondaryTypeID" DESC) n
  LEFT JOIN "StatusSecondaryType" d
         ON d."StatusSecondaryTypeID" = n.code AND n.code IN ({code_list(START + END + PRE_START)})
"""

ORACLES["legal_status"] = over_book("StatusSecondary", "StatusSecondaryType") + f"""
SELECT "CaseID" AS case_id, legal_status FROM ({LEGAL})
"""

ARA = """
  SELECT DISTINCT ON ("CaseID") * FROM "AraHistory"
  ORDER BY "CaseID", "EffectiveDate" DESC NULLS LAST, "DSTResolutionOptionID" DESC,
           "ProjectedEndDate" DESC
"""

INTEREST_ONLY_END = """CAST(CASE WHEN a."DSTResolutionOptionID" = 4 THEN a."ProjectedEndDate"
            WHEN lower(l."Repayment method") <> 'interest only' THEN NULL
            WHEN l."Repayment method" IS NULL THEN NULL
            WHEN x."ProductType" IN ('Fixed', 'Fixed (MARS)', 'Fixed (SCO22)', 'STAFF') THEN r."Period 1 end"
            ELSE i."MaturityDate" END AS VARCHAR)"""

FIX_FLOATING = (
    """CASE WHEN x."ProductType" IN ('Fixed', 'Fixed (MARS)', 'Fixed (SCO22)', 'STAFF') THEN 'F' ELSE 'V' END"""
)

ORACLES["interest_only_end"] = over_book(
    "Loan_TBL", "CaseInformation", "Rate_TBL", "Index_TBL", "AraHistory"
) + f"""
SELECT l."CaseID" AS case_id, {INTEREST_ONLY_END} AS interest_only_until,
       {FIX_FLOATING} AS fix_floating
FROM "Loan_TBL" l
LEFT JOIN "CaseInformation" i ON i."CaseID" = l."CaseID"
LEFT JOIN "Rate_TBL" r ON r."CaseID" = l."CaseID"
LEFT JOIN "Index_TBL" x ON x."IndexID" = r."IndexID"
LEFT JOIN ({ARA}) a ON a."CaseID" = l."CaseID"
"""

NEWEST_MARP = """
  SELECT "CaseID", max("MarpTypeID") AS marp_type, "ChangedOnDate" AS marp_on
  FROM "MarpTypeHistory" h
  WHERE "ChangedOnDate" = (SELECT max("ChangedOnDate") FROM "MarpTypeHistory" g
                           WHERE g."CaseID" = h."CaseID")
  GROUP BY "CaseID", "ChangedOnDate"
"""

BALANCES = """
  SELECT "CaseID", arg_max("Arrears", ("Date", "Arrears")) AS month_arrears
  FROM "MonthlyBalances_TBL" GROUP BY "CaseID"
"""

MARP_FLAGS = """CASE WHEN m.marp_type IN (3, 4) THEN 'M' WHEN m.marp_type = 1 THEN 'O'
            WHEN c."RegulatoryBodyId" = 2 AND l."Purpose" = 'BTL' AND b.month_arrears > 0
            THEN 'N' END"""

ORACLES["marp_flag"] = over_book(
    "Case_TBL", "Loan_TBL", "MarpTypeHistory", "MonthlyBalances_TBL"
) + f"""
SELECT c."CaseID" AS case_id, {MARP_FLAGS} AS marp_flag,
       CASE WHEN m.marp_type IN (3, 4) THEN 'Y' ELSE 'N' END AS marp_ind,
       CASE WHEN m.marp_type = 4 THEN 'Y' END AS pre_arrears
FROM "Case_TBL" c JOIN "Loan_TBL" l ON l."CaseID" = c."CaseID"
LEFT JOIN ({NEWEST_MARP}) m ON m."CaseID" = c."CaseID"
LEFT JOIN ({BALANCES}) b ON b."CaseID" = c."CaseID"
"""

# the literal form: look the newest date of the current type up again
MARP_DAY = """CAST(CASE WHEN m.marp_type = 1
              THEN (SELECT max(h."ChangedOnDate") FROM "MarpTypeHistory" h
                    WHERE h."CaseID" = m."CaseID" AND h."MarpTypeID" = 1)
            WHEN m.marp_type IN (3, 4)
              THEN (SELECT max(h."ChangedOnDate") FROM "MarpTypeHistory" h
                    WHERE h."CaseID" = m."CaseID" AND h."MarpTypeID" IN (3, 4)) END AS VARCHAR)"""

ORACLES["marp_date"] = over_book("MarpTypeHistory") + f"""
SELECT m."CaseID" AS case_id, {MARP_DAY} AS marp_day FROM ({NEWEST_MARP}) m
"""

SECURITIES = """
  SELECT s."CaseID", count(*) AS n
  FROM "CaseSecurity" s
  JOIN (SELECT "SecurityID", arg_max("StatusID", ("EffectiveDate", "StatusID")) AS status
        FROM "SecurityStatusHistory" GROUP BY "SecurityID") h
    ON h."SecurityID" = s."SecurityID" AND h.status <> 6
  GROUP BY s."CaseID"
"""

ORACLES["secured_flag"] = over_book("Case_TBL", "CaseSecurity", "SecurityStatusHistory") + f"""
SELECT c."CaseID" AS case_id, coalesce(s.n, 0) AS securities,
       CASE WHEN s.n > 0 THEN 'Y' ELSE 'N' END AS secured_ind
FROM "Case_TBL" c LEFT JOIN ({SECURITIES}) s ON s."CaseID" = c."CaseID"
"""

GUARANTOR = """CASE WHEN c."CaseID" IN (SELECT "CaseID" FROM "Facilitator"
                            WHERE "FacilitatorTypeID" = 3) THEN 'Y' ELSE 'N' END"""
NOTICES = """CASE WHEN c."CaseID" IN (SELECT "CaseID" FROM "Applicant_TBL"
                            WHERE "WithholdCommunication" = 1) THEN 'Y' ELSE 'N' END"""

ORACLES["guarantor_and_notices"] = over_book("Case_TBL", "Facilitator", "Applicant_TBL") + f"""
SELECT c."CaseID" AS case_id, {GUARANTOR} AS guarantor_ind, {NOTICES} AS stop_notices
FROM "Case_TBL" c
"""

NAMES = """
  SELECT "CaseID", string_agg(n, ', ' ORDER BY n) AS acc_name
  FROM (SELECT "CaseID", "First name" || ' ' || "Surname" AS n FROM "Applicant_TBL")
  WHERE n IS NOT NULL GROUP BY "CaseID"
"""

ORACLES["applicant_names"] = over_book("Case_TBL", "Applicant_TBL") + f"""
SELECT c."CaseID", n.acc_name
FROM "Case_TBL" c LEFT JOIN ({NAMES}) n ON n."CaseID" = c."CaseID"
"""


def _history(prefix: str, as_of: str) -> str:
    months = ",\n".join(
        f"CAST(max(\"Payments received\") FILTER (WHERE strftime(\"Month end\", '%Y-%m') = "
        f"strftime({as_of} - INTERVAL {k} MONTH, '%Y-%m')) AS DOUBLE) AS {prefix}{k}"
        for k in range(3, 13)
    )
    return f"""
  SELECT "CaseID", {months}
  FROM "ReceivedDue_TBL"
  WHERE datediff('month', "Month end", {as_of}) BETWEEN 3 AND 12
  GROUP BY "CaseID"
"""


ORACLES["payment_history"] = over_book("ReceivedDue_TBL") + _history("paid_", AS_OF)

# --- inputs and the whole extract ----------------------------------------------------

# columns read per table, by the input contract
READ = {
    "Applicant_TBL": 5, "AraHistory": 4, "CMSHistory_TBL": 3, "CaseInformation": 9,
    "CaseSecurity": 2, "Case_TBL": 8, "CreditGrade": 3, "Customer Details": 2,
    "DV_LoanTermRemaining": 2, "DirectDebitInstructions": 6, "Facilitator": 2, "Index_TBL": 4,
    "Loan Details": 3, "Loan_TBL": 11, "MarpTypeHistory": 3, "MonthlyBalances_TBL": 3,
    "PaymentFrequency": 2, "Rate_TBL": 3, "ReceivedDue_TBL": 3, "SecurityStatusHistory": 3,
    "StatusHistory_TBL": 4, "StatusSecondary": 4, "StatusSecondaryType": 2, "Status_TBL": 2,
    "TransactionType_TBL": 3, "Transaction_TBL": 4, "MissedOrLatePayments": 0,
}

ORACLES["loan_book_inputs"] = over_book(*BOOK) + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, CAST({n} AS BIGINT) AS n_columns_read, "
    f'count(*) AS n_rows FROM "{name}"'
    for name, n in READ.items()
)


RATE_PER_LINE = """
  SELECT l_orderkey AS "CaseID", l_linenumber % 6 AS "IndexID",
         CAST(l_shipdate AS DATE) AS "Period 1 end"
  FROM lineitem
"""


def _extract(as_of: str, rates: str = 'SELECT * FROM "Rate_TBL"', until: str | None = None) -> str:
    history = ",\n       ".join(f'ph."PMT_HIS_{k}"' for k in range(3, 13))
    return over_book(*[n for n in BOOK if n != "MissedOrLatePayments"], until=until) + f"""
, names AS ({NAMES}), recoded AS ({RECODED}),
residency AS (
  SELECT a."CaseID", c."Borrower Residency" AS r
  FROM ({DECLARED}) a
  JOIN (SELECT id, "Borrower Residency" FROM recoded) c ON c.id = a.b
),
refs AS (
  SELECT "CaseID", string_split("Original Reference", '-') AS p FROM "Case_TBL"
  WHERE contains("Original Reference", '-')
),
origin AS (
  SELECT f."CaseID", f.p[len(f.p)] AS sub, d."Origination Date" AS od
  FROM refs f LEFT JOIN "Loan Details" d
    ON d."Loan ID" = f.p[1] AND d."Sub Loan ID" = f.p[len(f.p)]
),
status AS ({STATUS}), lit AS ({LITIGATION}), legal AS ({LEGAL}), ara AS ({ARA}),
marp AS ({NEWEST_MARP}), balance AS ({BALANCES}), sec AS ({SECURITIES}),
pay AS ({PAYMENTS}), any_dd AS ({ANY_MANDATE}), dd AS ({ACTIVE_MANDATE}),
ph AS ({_history("PMT_HIS_", as_of)}),
cms AS (SELECT "CaseID", CAST(arg_max("CMS", ("CMS Month", "CMS")) AS DOUBLE) AS cms
        FROM "CMSHistory_TBL" GROUP BY "CaseID"),
grade AS (SELECT DISTINCT ON ("CaseID") "CaseID", "Grade" FROM "CreditGrade"
          ORDER BY "CaseID", "DateOfChange" DESC NULLS LAST, "Grade")
SELECT names.acc_name AS "ACC_NAME", c."AccountNumber" AS "MORTGAGE_ID", {ACC_NO} AS "ACC_NO",
       origin.sub AS "UB_SUB_LOAN_ID",
       CAST(CAST(l."AIBCompletionDate" AS DATE) AS VARCHAR) AS "ACC_SETUP_DTE",
       CAST(CAST(l."AIBCompletionDate" AS DATE) AS VARCHAR) AS "DRAWN_BAL_ORIGINATION_DTE",
       CAST(i."CurBal" AS DOUBLE) AS "BAL_FOR_INT", CAST(i."CurBal" AS DOUBLE) AS "BAL_AMT",
       CAST(i."CurBal" - i."ArrearsLME" AS DOUBLE) AS "NET_LIMIT_FOR_PRNCPL",
       CASE WHEN coalesce(i."OutstandingArrears", 0) > 0 THEN 'Y' ELSE 'N' END AS "ARREARS_IND",
       CAST(i."OutstandingArrears" AS DOUBLE) AS "ARREARS_AMT",
       CAST(i."OutstandingArrears" AS DOUBLE) AS "TOT_ARREARS_EXCL_TRS_AMT",
       CAST(coalesce({as_of} - i."DateFirstInArrears", 0) AS BIGINT) AS "DAYS_IN_ARREARS",
       CAST(i."DateFirstInArrears" AS VARCHAR) AS "ARREARS_DTE",
       'IE' AS "CNTRY_OF_RISK", CAST(365 AS BIGINT) AS "DAY_CNT_CONVENTION_CDE",
       residency.r AS "CNTRY_OF_ULTIMATE_RISK_CDE", residency.r AS "ISO_CNTRY_CDE",
       {percent('x."Index rate"')} AS "BASE_RTE", {percent('i."PayRateNow"')} AS "DR_INT_RTE",
       dd."BIC" AS "BIC", dd."SortCode" AS "BR_CDE_FK", dd."IBAN" AS "IBAN",
       status.status AS "ACC_STA_CDE", status.close_day AS "CLOSE_DTE",
       {GUARANTOR} AS "GUARANTOR_IND", {NOTICES} AS "STOP_NOTICES",
       CASE WHEN sec.n > 0 THEN 'Y' ELSE 'N' END AS "SECURED_IND",
       CAST(i."MaturityDate" AS VARCHAR) AS "CNTRACT_MATURITY_DTE",
       {months_between('l."Completion Date"', 'i."MaturityDate"')} AS "TERM_NO_UNITS",
       CASE WHEN t."Remaining term" IS NOT NULL
            THEN CAST(greatest(t."Remaining term", 0) AS BIGINT) END AS "REMAINING_TERM",
       cms.cms AS "CURR_TOT_INSTALMT_AMT", cms.cms AS "PAYMENT_AMOUNT", cms.cms AS "RPMT_DUE_AMT",
       CAST(i."CurrentRateEffectiveDate" AS VARCHAR) AS "CURR_RT_EFF_DT",
       CAST(i."CurrentRateEffectiveDate" AS VARCHAR) AS "PRICING_DTE",
       CAST(l."Original loan amount" AS DOUBLE) AS "DRAWN_BAL_AT_ORIGINATION_AMT",
       CAST(CAST(origin.od AS DATE) AS VARCHAR) AS "FIRST_TRANS_DTE",
       CASE WHEN l."FirstTimeBuyer" = 1 THEN 'Y' ELSE 'N' END AS "FIRST_TIME_BUYER_IND",
       q."Name" AS "INT_PMT_FREQ_CDE", q."Name" AS "TOT_INSTALMT_PMT_FREQ_CDE",
       CASE WHEN q."Name" = 'Annually' THEN 'Y' ELSE 'M' END AS "TERM_UNIT",
       {FIX_FLOATING} AS "FIX_FLOATING_IND", x."Index name" AS "FUNDING_CATEGORY",
       CAST(r."Period 1 end" AS VARCHAR) AS "FXD_INT_END_DTE",
       CAST(r."Period 1 end" AS VARCHAR) AS "NXT_REPRICING_DTE",
       CAST(coalesce(r."Period 1 end", i."MaturityDate") AS VARCHAR) AS "NXT_RESET_DTE",
       i."AibProductCode" AS "SRCE_PROD_CDE_FK",
       {INTEREST_ONLY_END} AS "INT_ONLY_END_DTE",
       CASE WHEN lower(l."Repayment method") = 'interest only' THEN 'Y' ELSE 'N' END
         AS "INT_ONLY_IND",
       CAST(NULL AS DOUBLE) AS "CURR_PRNCPL_INSTALMT_AMT",
       CAST(NULL AS VARCHAR) AS "CANCELLED_EXPIRED", CAST(NULL AS VARCHAR) AS "DOWNGRADE_INDICATOR",
       l."CreditGradeOverride" AS "OVERRIDE_GRD", grade."Grade" AS "ACCOUNT_GRADE",
       l."Currency" AS "ISO_CRNCY_CDE", CAST(pay.paid_on AS VARCHAR) AS "LAST_DR_DTE",
       {PAID_BY} AS "PAYMENT_METHOD",
       CAST(CAST(date_trunc('month', {as_of}) + INTERVAL 1 MONTH AS DATE) AS VARCHAR)
         AS "NEXT_INT_CHARGE",
       {due('c."PaymentDay"', as_of)} AS "NEXT_PRINCP_CHARGE",
       {due('c."PaymentDay"', as_of)} AS "NEXT_RPMT_DTE",
       {due('c."PaymentDay"', as_of)} AS "NXT_INT_PMT_DTE",
       CASE WHEN m.marp_type IN (1, 3, 4) THEN CAST(m.marp_on AS VARCHAR) END AS "MARP_DTE",
       {MARP_FLAGS.replace("b.month", "balance.month")} AS "MARP_FLAG",
       CASE WHEN m.marp_type IN (3, 4) THEN 'Y' ELSE 'N' END AS "MARP_IND",
       CASE WHEN m.marp_type = 4 THEN 'Y' END AS "PRE_ARREARS",
       coalesce(l."Originator", 'ULSTER BANK') AS "ORIGINATION_ENTITY",
       {history},
       CAST(c."PaymentDay" AS VARCHAR) AS "REG_RPMT_DAY", c."PurposeCode" AS "PURPOSE_CDE",
       CAST(CAST(round(c."SectorCode", 0) AS BIGINT) AS VARCHAR) AS "SECTOR_CDE_FK",
       legal.legal_status AS "LEGAL_STA_DESCR",
       lit."LTGTN_START_DTE", lit."LTGTN_END_DTE", lit."PRE_LTGTN_START_DTE",
       lit."PRE_LTGTN_END_DTE"
FROM "Case_TBL" c
JOIN "Loan_TBL" l ON l."CaseID" = c."CaseID"
LEFT JOIN "PaymentFrequency" q ON q."Id" = l."PaymentFrequencyID"
LEFT JOIN names ON names."CaseID" = c."CaseID"
LEFT JOIN residency ON residency."CaseID" = c."CaseID"
LEFT JOIN origin ON origin."CaseID" = c."CaseID"
LEFT JOIN "CaseInformation" i ON i."CaseID" = c."CaseID"
LEFT JOIN balance ON balance."CaseID" = c."CaseID"
LEFT JOIN ({rates}) r ON r."CaseID" = c."CaseID"
LEFT JOIN "Index_TBL" x ON x."IndexID" = r."IndexID"
LEFT JOIN cms ON cms."CaseID" = c."CaseID"
LEFT JOIN ara a ON a."CaseID" = c."CaseID"
LEFT JOIN marp m ON m."CaseID" = c."CaseID"
LEFT JOIN dd ON dd."CaseID" = c."CaseID"
LEFT JOIN any_dd ON any_dd."CaseID" = c."CaseID"
LEFT JOIN "DV_LoanTermRemaining" t ON t."CaseID" = c."CaseID"
LEFT JOIN status ON status."CaseID" = c."CaseID"
LEFT JOIN legal ON legal."CaseID" = c."CaseID"
LEFT JOIN lit ON lit."CaseID" = c."CaseID"
LEFT JOIN pay ON pay."CaseID" = c."CaseID"
LEFT JOIN ph ON ph."CaseID" = c."CaseID"
LEFT JOIN sec ON sec."CaseID" = c."CaseID"
LEFT JOIN grade ON grade."CaseID" = c."CaseID"
ORDER BY "ACC_NO"
"""


ORACLES["account_extract"] = _extract(AS_OF)
ORACLES["account_extract_char_bit"] = _extract(AS_OF)
ORACLES["account_extract_mid_month"] = _extract(AS_OF_SHORT)
ORACLES["account_extract_repeated_cases"] = _extract(AS_OF, RATE_PER_LINE)
ORACLES["account_extract_spread"] = _extract(AS_OF, RATE_PER_LINE)

ORACLES["unique_outer_join"] = """
SELECT coalesce(s.s_suppkey, c.k) AS k, s.s_name, c.c_name
FROM supplier s
FULL JOIN (SELECT CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS k, c_name FROM customer) c
  ON c.k = s.s_suppkey
"""

STATE_DATES = ("1997-03-31", "1998-09-15", "2000-01-31")


def _at(name: str, order: str) -> str:
    day = DAYS[name]
    return f"""SELECT DISTINCT ON (h."CaseID", d.as_of) h.*, d.as_of FROM "{name}" h
      JOIN dates d ON h."{day}" IS NULL OR CAST(h."{day}" AS DATE) <= d.as_of
      ORDER BY h."CaseID", d.as_of, h."{day}" DESC NULLS LAST, {order}"""


ORACLES["account_state_over_dates"] = over_book(
    "Loan_TBL", "MonthlyBalances_TBL", "CMSHistory_TBL", "StatusHistory_TBL", "Status_TBL", "MarpTypeHistory", "CreditGrade"
) + f""", dates AS (SELECT unnest([{", ".join(f"DATE '{d}'" for d in STATE_DATES)}]) AS as_of),
balance AS ({_at("MonthlyBalances_TBL", 'h."Arrears" DESC NULLS LAST')}),
cms AS ({_at("CMSHistory_TBL", 'h."CMS" DESC NULLS LAST')}),
status AS ({_at("StatusHistory_TBL", 'h."Effective date" DESC NULLS LAST, h."StatusID" DESC NULLS LAST')}),
marp AS ({_at("MarpTypeHistory", 'h."MarpTypeID" DESC NULLS LAST')}),
grade AS ({_at("CreditGrade", 'h."Grade" ASC NULLS FIRST')})
SELECT l."CaseID" AS case_id, CAST(d.as_of AS VARCHAR) AS as_of,
       CAST(b."Arrears" AS DOUBLE) AS month_arrears, CAST(b."Date" AS VARCHAR) AS balance_day,
       CAST(m."CMS" AS DOUBLE) AS instalment, s."Status" AS status,
       CAST(p."MarpTypeID" AS BIGINT) AS marp_type, g."Grade" AS grade
FROM (SELECT DISTINCT "CaseID" FROM "Loan_TBL") l CROSS JOIN dates d
LEFT JOIN balance b ON b."CaseID" = l."CaseID" AND b.as_of = d.as_of
LEFT JOIN cms m ON m."CaseID" = l."CaseID" AND m.as_of = d.as_of
LEFT JOIN status h ON h."CaseID" = l."CaseID" AND h.as_of = d.as_of
LEFT JOIN "Status_TBL" s ON s."StatusID" = h."StatusID"
LEFT JOIN marp p ON p."CaseID" = l."CaseID" AND p.as_of = d.as_of
LEFT JOIN grade g ON g."CaseID" = l."CaseID" AND g.as_of = d.as_of
"""
ORACLES["account_extract_point_in_time"] = _extract(f"DATE '{STATE_DATES[1]}'", until=f"DATE '{STATE_DATES[1]}'")
