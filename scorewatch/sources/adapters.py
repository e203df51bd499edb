"""Logical monitoring tables derived from the shared test tables.

The monitoring reports read score tables, outcome tables, loan features,
repayment events and a few operational tables. The shared test data is a
star schema (orders, lineitem, customer, events, nation), so each logical
table below is a fixed mapping from those tables. Every mapping keeps all
rows of its source; nothing is sampled or capped.

Each adapter is one SQL text written in the subset of SQL that both Spark
SQL and DuckDB accept. Spark runs it with ``spark.sql(text, **frames)``
(DataFrames bound to the ``{placeholders}``), and the DuckDB oracle inlines
the same text as a CTE, so both engines see identical inputs.

Mapping summary (cid = customer key as string):

* ``onboarding``      customer -> onboarding date spread over 1995-2001
* ``scores_api``      orders   -> production score per (cid, run date)
* ``scores_batch``    lineitem x orders -> batch scores with duplicate lines
* ``targets``         customer -> repay target (acctbal) and maturity flag
* ``resignation``     customer -> resolved resignation date (some null)
* ``backscore_*``     customer / orders -> re-scored models
* ``features``        orders   -> loan rows with dirty resignation strings
* ``repayments``      lineitem x orders -> repayment events per loan (some without loan, date or amount)
* ``users`` ...       customer / events / nation -> operational tables
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Onboarding date of a customer: a fixed spread over ~6.5 years.
ONB_C = "(DATE '1995-01-01' + CAST((c_custkey * 7919) % 2400 AS INT))"
ONB_O = "(DATE '1995-01-01' + CAST((o_custkey * 7919) % 2400 AS INT))"

# Production repay score of an order row and its (jittered) segment letter.
# Letter D is never produced, so cut-point interpolation is exercised.
_PROD_SCORE = "LEAST(o_totalprice / 400000, CAST(1 AS DOUBLE))"
_PROD_SEG = f"""CASE
      WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
      WHEN {_PROD_SCORE} + CAST(o_orderkey % 5 - 2 AS DOUBLE) / 20 >= 0.75 THEN 'A'
      WHEN {_PROD_SCORE} + CAST(o_orderkey % 5 - 2 AS DOUBLE) / 20 >= 0.55 THEN 'B'
      WHEN {_PROD_SCORE} + CAST(o_orderkey % 5 - 2 AS DOUBLE) / 20 >= 0.35 THEN 'C'
      WHEN {_PROD_SCORE} + CAST(o_orderkey % 5 - 2 AS DOUBLE) / 20 >= 0.15 THEN 'E'
      ELSE 'F' END"""
_TTL = "CASE WHEN o_orderkey % 14 = 0 THEN '12+' ELSE CAST(o_orderkey % 14 AS STRING) END"

# Calendar month after the order month, day 15 (score calculation date).
_CALC_DATE = """make_date(CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) = 12 THEN 1 ELSE 0 END AS INT),
                         CAST(month(o_orderdate) % 12 + 1 AS INT), 15)"""

# Dirty-date string of a loan (resignation date as typed by HR).
_D = "(CAST(o_orderdate AS DATE) + 400)"
_Y = f"CAST(year({_D}) AS STRING)"
_M = f"CAST(month({_D}) AS STRING)"
_DD = f"CAST(day({_D}) AS STRING)"
_M2 = f"lpad({_M}, 2, '0')"
_D2 = f"lpad({_DD}, 2, '0')"
_DIRTY = f"""CASE o_orderkey % 10
      WHEN 0 THEN {_Y} || '-' || {_M2} || '-' || {_D2}
      WHEN 1 THEN {_Y} || '/' || {_M} || '/' || {_DD}
      WHEN 2 THEN {_Y} || '.' || {_M2}
      WHEN 3 THEN {_Y} || {_M2} || {_D2}
      WHEN 4 THEN {_D2} || '-' || {_M2} || '-' || {_Y}
      WHEN 5 THEN {_M} || '-' || {_DD} || '-' || {_Y}
      WHEN 6 THEN NULL
      WHEN 7 THEN CASE o_orderstatus WHEN 'F' THEN 'nan' WHEN 'O' THEN '' ELSE 'n/a' END
      WHEN 8 THEN {_Y} || '-02-30'
      ELSE '1850-' || {_M2} || '-' || {_D2} END"""

ADAPTERS: dict[str, str] = {
    "onboarding": f"""
SELECT CAST(c_custkey AS STRING) AS ee_customer_id,
       CASE WHEN c_custkey % 23 = 5 THEN NULL ELSE {ONB_C} END AS ee_onboarding_date
FROM {{customer}}""",

    "scores_api": f"""
SELECT CAST(o_custkey AS STRING) AS ee_customer_id,
       CAST(o_orderdate AS DATE) AS run_date,
       o_orderkey AS run_key,
       CASE WHEN o_orderkey % 3 = 0 THEN 'High' ELSE 'Low' END AS attrition_risk_segment,
       {_TTL} AS attrition_time_to_leave,
       {_PROD_SCORE} AS oop_score_prod,
       {_PROD_SEG} AS oop_risk_segment_prod,
       FLOOR(o_totalprice * 10) / 100 AS credit_limit
FROM {{orders}}""",

    # One row per order line: the batch table repeats a score once per line,
    # the duplicate-run case the batch dedup (H4) removes.
    "scores_batch": f"""
SELECT CAST(o_custkey AS STRING) AS ee_customer_id,
       o_orderdate AS run_date,
       o_orderkey AS run_key,
       CASE WHEN o_orderkey % 3 = 0 THEN 'High' ELSE 'Low' END AS attrition_risk_segment,
       {_TTL} AS attrition_time_to_leave,
       {_PROD_SCORE} AS oop_score_prod,
       {_PROD_SEG} AS oop_risk_segment_prod
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",

    "targets": """
SELECT CAST(c_custkey AS STRING) AS user_id,
       CASE WHEN c_acctbal >= 2000 THEN 1 ELSE 0 END AS target,
       CASE WHEN c_mktsegment <> 'FURNITURE' THEN 1 ELSE 0 END AS target_maturity_flag,
       CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY') AND c_custkey % 11 <> 4
            THEN DATE '1995-01-01' + CAST((c_custkey * 7919) % 2400 + (c_custkey * 131) % 900 AS INT) END AS ee_resignation_date_correct
FROM {customer}""",

    "resignation": f"""
SELECT CAST(c_custkey AS STRING) AS ee_customer_id,
       CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY')
            THEN {ONB_C} + CAST((c_custkey * 131) % 900 AS INT) END AS ee_resignation_date_correct
FROM {{customer}}""",

    "backscore_oop_new": """
SELECT CAST(c_custkey AS STRING) AS ee_customer_id,
       CASE WHEN c_nationkey = 0 THEN NULL
            ELSE CAST((c_custkey * 37) % 1000 AS DOUBLE) / 1000 END AS score_oop,
       GREATEST(c_acctbal, 0) * 10 AS osbal_as_of_resignation_date,
       GREATEST(c_acctbal - 500, 0) * 10 AS osbal_as_of_oop_eligible_date,
       GREATEST(c_acctbal - 1500, 0) * 10 AS osbal_as_of_current_date
FROM {customer}""",

    # One row per (customer, calculation month): the attributes of the
    # month's first order, taken from its key (min(o_orderkey) is a hash
    # aggregate; the attributes are functions of the key).
    "backscore_oop_existing": f"""
SELECT ee_customer_id, calc_date, CAST((k * 37) % 1000 AS DOUBLE) / 1000 AS score_oop
FROM (SELECT CAST(o_custkey AS STRING) AS ee_customer_id, {_CALC_DATE} AS calc_date, min(o_orderkey) AS k
      FROM {{orders}}
      GROUP BY o_custkey, {_CALC_DATE}) t""",

    "backscore_attrition": f"""
SELECT ee_customer_id, calc_date,
       CASE WHEN o_custkey % 31 = 7 THEN NULL
            WHEN (k * 13) % 17 >= 15 THEN CAST('Infinity' AS DOUBLE)
            ELSE CAST((k * 13) % 17 + 1 AS DOUBLE) END AS score_attr,
       CASE WHEN (k * 13) % 17 >= 15 THEN 'Very low' WHEN (k * 13) % 17 < 3 THEN 'Very high'
            WHEN (k * 13) % 17 < 6 THEN 'High' WHEN (k * 13) % 17 < 9 THEN 'Average'
            WHEN (k * 13) % 17 < 12 THEN 'Low' ELSE 'Very low' END AS score_attr_segment,
       ee_onboarding_month, is_new_customer_flag_3m
FROM (SELECT o_custkey, CAST(o_custkey AS STRING) AS ee_customer_id, {_CALC_DATE} AS calc_date,
             min(o_orderkey) AS k,
             CAST(year({ONB_O}) * 100 + month({ONB_O}) AS INT) AS ee_onboarding_month,
             CASE WHEN (year(o_orderdate) * 12 + month(o_orderdate)) - (year({ONB_O}) * 12 + month({ONB_O}))
                       BETWEEN 0 AND 2 THEN 1 ELSE 0 END AS is_new_customer_flag_3m
      FROM {{orders}}
      GROUP BY o_custkey, {_CALC_DATE}, year(o_orderdate), month(o_orderdate)) t""",

    # Loan grain: one row per order.
    "features": f"""
SELECT CAST(o_custkey AS STRING) AS ee_customer_id,
       CAST(o_orderkey AS STRING) AS ln_loan_id,
       o_orderkey AS ln_seq,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'payroll' ELSE 'employer' END AS ee_product_type,
       CASE WHEN o_custkey % 23 = 5 THEN NULL ELSE CAST({ONB_O} AS TIMESTAMP) END AS ee_onboarding_date,
       {_DIRTY} AS ee_resignation_date,
       CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 200 DAY END AS ee_permanent_freeze_date,
       o_totalprice AS ln_original_principal,
       o_totalprice / 10 AS ln_orig_interest_fees
FROM {{orders}}""",

    "repayments": """
SELECT CAST(o_custkey AS STRING) AS user_id,
       CASE WHEN l_suppkey % 41 = 7 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS loan_id,
       CASE WHEN l_returnflag = 'R' THEN 'TPFP' ELSE 'TPSD' END AS vendor_id,
       CASE WHEN l_partkey % 53 = 3 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS repaid_date,
       l_linenumber AS installment_number,
       l_extendedprice * (1 + l_tax) AS outstanding_balance,
       l_extendedprice AS paid_amount,
       CASE WHEN l_partkey % 29 = 11 THEN NULL ELSE FLOOR(l_extendedprice * (1 - l_discount) * 100) / 100 END AS paid_principal,
       l_partkey AS part_key,
       l_suppkey AS supp_key
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",

    # ---- operational tables (funnels, profile, points scorecard) ----
    "users": """
SELECT c_custkey AS id,
       CAST(DATE '1994-06-01' + CAST((c_custkey * 7919) % 2400 AS INT) AS TIMESTAMP) AS created_at,
       CAST(c_nationkey AS STRING) AS employer_id,
       CASE c_nationkey % 4 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' WHEN 2 THEN 'not specified' ELSE NULL END AS gender,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Married' WHEN 'AUTOMOBILE' THEN 'Single'
                         WHEN 'MACHINERY' THEN 'Widowed' WHEN 'HOUSEHOLD' THEN 'Divorced' ELSE NULL END AS civil_status,
       CASE WHEN c_nationkey IN (3, 7) THEN 'payroll' WHEN c_nationkey = 11 THEN 'merchant' ELSE 'employer' END AS product_type,
       CASE WHEN c_custkey % 17 = 3 THEN 1 ELSE 2 END AS account_activated
FROM {customer}""",

    "income_info": f"""
SELECT c_custkey AS user_id,
       CAST({ONB_C} AS TIMESTAMP) AS created_at,
       CASE c_custkey % 4
            WHEN 0 THEN CAST(1980 + c_custkey % 40 AS STRING) || '-' || CAST(1 + c_custkey % 12 AS STRING)
            WHEN 1 THEN CAST(1980 + c_custkey % 40 AS STRING) || '-' || lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0')
            WHEN 2 THEN CAST(1980 + c_custkey % 40 AS STRING) || '-' || lpad(CAST(1 + c_custkey % 12 AS STRING), 2, '0')
                        || '-' || lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0')
            ELSE NULL END AS employment_date,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'probationary' ELSE 'regular' END AS employee_status,
       CASE WHEN c_acctbal < 0 THEN '0-10000'
            WHEN c_acctbal < 2000 THEN '10000-20000'
            WHEN c_acctbal < 4000 THEN '20000-30000'
            WHEN c_acctbal < 6000 THEN '30000-40000'
            WHEN c_acctbal < 7000 THEN '40000-50000'
            WHEN c_acctbal < 8000 THEN '50000+'
            ELSE CAST(CAST(FLOOR(c_acctbal * 5) AS BIGINT) AS STRING) END AS income,
       c_acctbal * 4 AS verified_net_income
FROM {{customer}}""",

    "user_timelines": f"""
SELECT c_custkey AS user_id,
       CASE WHEN c_custkey % 23 = 5 THEN NULL ELSE CAST({ONB_C} AS TIMESTAMP) END AS first_account_activated_at
FROM {{customer}}""",

    "user_tag": """
SELECT user_id,
       CASE event_type WHEN 'error' THEN 100 WHEN 'signup' THEN 39 WHEN 'click' THEN 101 ELSE 7 END AS tag_id,
       CASE event_type WHEN 'error' THEN 'resigned' WHEN 'signup' THEN 'frozen' WHEN 'click' THEN 'on_hold' ELSE 'other' END AS tag_name,
       ts AS created_at,
       CASE WHEN value > 40 THEN ts + INTERVAL 1 DAY END AS deleted_at
FROM {events}""",

    "employers": """
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM {nation}""",

    "credit_info": """
SELECT c_custkey AS user_id, 'credit-limit' AS key, CAST(CAST(FLOOR(GREATEST(c_acctbal, 0) * 3) AS BIGINT) AS STRING) AS value
FROM {customer}
UNION ALL
SELECT c_custkey AS user_id, 'segment' AS key, c_mktsegment AS value
FROM {customer}""",

    "payment_responses": """
SELECT user_id AS payer_user_id, ts - INTERVAL 1 DAY * (user_id * 37 % 700) AS created_at,
       CASE event_type WHEN 'purchase' THEN 'PTOK' WHEN 'signup' THEN 'CTOK' ELSE 'FAIL' END AS status
FROM {events}""",

    "repayment_responses": """
SELECT o_custkey AS user_id,
       CASE WHEN l_returnflag = 'R' THEN 'TPFP' WHEN l_returnflag = 'A' THEN 'TPSD' ELSE 'CARD' END AS vendor_id,
       l_shipdate + INTERVAL 1 HOUR * l_linenumber AS repaid_at
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",

    "cl_summary": f"""
SELECT CAST(c_custkey AS STRING) AS user_id,
       {ONB_C} >= DATE '2000-01-01' AS is_new_user,
       c_acctbal > 5000 AS has_cl_plus
FROM {{customer}}""",

    "cl_changes": f"""
SELECT CAST(c_custkey AS STRING) AS user_id,
       GREATEST(c_acctbal, 0) AS old_cl,
       GREATEST(c_acctbal, 0) + CASE c_nationkey % 3 WHEN 0 THEN 250 WHEN 1 THEN 0 ELSE -CAST(400 AS DOUBLE) END AS new_cl,
       c_custkey % 5 <> 2 AS is_existing_user,
       CASE WHEN c_custkey % 7 = 1 THEN NULL ELSE {ONB_C} + 30 END AS cl_plus_start_date
FROM {{customer}}""",

    "portfolio_snapshot": """
SELECT last_day(CAST(l_shipdate AS DATE)) AS report_month_end,
       l_extendedprice AS credit_limit,
       CASE WHEN l_linestatus = 'O' THEN FLOOR(l_extendedprice * (1 - l_discount) * 100) / 100 ELSE 0 END AS unpaid_principal_balance
FROM {lineitem}""",
}

# Base tables (or other adapters) each adapter reads.
DEPENDS: dict[str, tuple[str, ...]] = {
    name: tuple(sorted({tok for tok in ("customer", "orders", "lineitem", "events", "nation")
                        if "{" + tok + "}" in text}))
    for name, text in ADAPTERS.items()
}


def logical_table(spark: SparkSession, tables, name: str) -> DataFrame:
    """Spark side: bind the base DataFrames and run the adapter SQL."""
    frames = {dep: tables[dep] for dep in DEPENDS[name]}
    return spark.sql(ADAPTERS[name], **frames)


def cte_prefix(names) -> str:
    """DuckDB side: ``WITH name AS (...), ...`` for the adapters used."""
    parts = []
    for n in names:
        body = ADAPTERS[n].format(**{d: d for d in DEPENDS[n]})
        parts.append(f"{n} AS ({body}\n)")
    return "WITH " + ",\n".join(parts) + "\n"


class Logical:
    """Lazy access to all logical tables of one data directory."""

    def __init__(self, spark: SparkSession, tables):
        self.spark = spark
        self.tables = tables
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = logical_table(self.spark, self.tables, name)
        return self._cache[name]
