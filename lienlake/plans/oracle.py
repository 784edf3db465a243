"""Plain-SQL statements of every checked query, runnable by DuckDB over the
driver tables (region, nation, customer, part, orders, lineitem, events ...).

They are the independent statement of each query's semantics: written as
SQL over the raw tables, not generated from the Spark plans.  Shared steps
are named CTEs; ``sql_for`` emits only the CTEs a query needs, in dependency
order.
"""

from __future__ import annotations

import re


def M(expr: str) -> str:
    """An exact money total: decimals of 1e-8, rounded to 6 places."""
    return f"CAST(CAST(ROUND(SUM(CAST({expr} AS DECIMAL(38,8))), 6) AS DECIMAL(38,6)) AS DOUBLE)"


# --- fixture adapter (the fixture contract's mapping, verbatim semantics) ---
CTES: dict[str, str] = {
    "x_customer": """
SELECT c_custkey AS customer_id, c_name AS full_name, c_name AS pan,
  CASE WHEN c_custkey % 100 < 90 THEN 'VERIFIED' WHEN c_custkey % 100 < 97 THEN 'PENDING' ELSE 'REJECTED' END AS kyc_status,
  CASE WHEN c_acctbal < 0 THEN 'HIGH' WHEN c_acctbal < 5000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_category,
  n_name AS city, r_name AS state
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "x_scheme": """
SELECT p_partkey AS scheme_code, p_name AS scheme_name, p_brand AS amc,
  CASE WHEN p_type IN ('SMALL','MEDIUM') THEN 'EQUITY' WHEN p_type IN ('LARGE','STANDARD') THEN 'HYBRID' ELSE 'DEBT' END AS category,
  CASE WHEN p_type IN ('SMALL','MEDIUM') THEN 50e0 WHEN p_type IN ('LARGE','STANDARD') THEN 60e0 ELSE 75e0 END AS eligible_ltv_pct
FROM part""",
    "x_nav_raw": """
SELECT p_partkey AS scheme_code, CAST(DATE '2024-01-01' + INTERVAL '1' DAY * k AS DATE) AS nav_date,
  CASE WHEN v = 1 THEN p_retailprice
       WHEN p_partkey % 97 = 0 AND k = 4 THEN 0e0
       ELSE p_retailprice * (1 + ((p_partkey * 7 + k * 13) % 21 - 10) / 100e0) END AS nav,
  CASE WHEN v = 1 THEN '23:00' ELSE '23:30' END AS published_at
FROM part CROSS JOIN (VALUES (0),(1),(2),(3),(4)) AS d(k) CROSS JOIN (VALUES (1),(2)) AS r(v)
WHERE (v = 2 OR p_partkey % 10 = 0) AND NOT (v = 1 AND p_partkey % 97 = 0)""",
    "x_holding_raw": """
SELECT l_orderkey * 8 + l_linenumber AS holding_id, o_custkey AS customer_id, 
  CASE WHEN (l_orderkey * 8 + l_linenumber) % 211 = 0 THEN -l_partkey ELSE l_partkey END AS scheme_code,
  CASE WHEN (l_orderkey * 8 + l_linenumber) % 223 = 0 THEN -l_quantity WHEN (l_orderkey * 8 + l_linenumber) % 227 = 0 THEN NULL
    ELSE l_quantity END AS units_pledged,
  CASE WHEN (l_orderkey * 8 + l_linenumber) % 229 = 0 THEN 'UNKNOWN' WHEN l_returnflag = 'N' THEN 'REQUESTED'
    WHEN l_returnflag = 'A' THEN 'MARKED' ELSE 'RELEASED' END AS lien_status,
  CAST(l_shipdate AS DATE) AS as_of_date, l_suppkey, l_extendedprice, l_orderkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_custkey % 20 <> 0""",
    "x_loan": """
SELECT o_orderkey AS loan_id, o_custkey AS customer_id, 'OD' AS product_type,
  CASE WHEN o_orderkey % 331 = 0 THEN -o_totalprice WHEN o_orderkey % 337 = 0 THEN NULL ELSE o_totalprice END AS outstanding,
  9.5e0 + (o_orderkey % 9) * 0.5e0 AS annual_rate
FROM orders""",
    "x_disbursement": """
SELECT o_orderkey * 10 + 1 AS disbursement_id, CASE WHEN o_orderkey % 347 = 0 THEN -o_orderkey ELSE o_orderkey END AS loan_id,
  o_custkey AS customer_id, o_totalprice AS amount, CAST(o_orderdate AS DATE) AS disbursed_at,
  CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' ELSE 'PENDING' END AS status
FROM orders""",
    "x_repayment": """
SELECT l_orderkey * 8 + l_linenumber AS repayment_id, l_orderkey AS loan_id, l_extendedprice * l_discount AS amount,
  CAST(DATE '2024-01-05' - INTERVAL '1' DAY * CAST((year(l_shipdate) * 372 + month(l_shipdate) * 31 + day(l_shipdate)) % 160 - 60 AS INT) AS DATE) AS paid_at,
  CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESS' END AS status
FROM lineitem""",
}

# --- silver ---
CTES.update({
    "s_customer": """
SELECT customer_id, full_name, kyc_status, risk_category, city, state, sha256(upper(pan)) AS pan_token
FROM x_customer""",
    "s_nav_clean": "SELECT scheme_code, nav_date, nav, published_at FROM x_nav_raw WHERE nav > 0",
    "s_nav": """
SELECT scheme_code, nav_date, nav, published_at FROM (
  SELECT *, row_number() OVER (PARTITION BY scheme_code, nav_date ORDER BY published_at DESC, nav DESC) AS rn FROM s_nav_clean) WHERE rn = 1""",
    "s_hold_valid": """
SELECT h.* FROM x_holding_raw h WHERE units_pledged >= 0 AND EXISTS (SELECT 1 FROM x_scheme s WHERE s.scheme_code = h.scheme_code)""",
    "s_holding": """
SELECT holding_id, customer_id, scheme_code, units_pledged, lien_status, as_of_date, l_suppkey, l_extendedprice, l_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY holding_id ORDER BY as_of_date DESC, scheme_code DESC, l_suppkey DESC, l_extendedprice DESC,
    customer_id DESC, units_pledged DESC, lien_status DESC) AS rn FROM s_hold_valid) WHERE rn = 1""",
    "s_loan": "SELECT * FROM x_loan WHERE outstanding >= 0",
})

AS_OF = "(SELECT max(nav_date) FROM s_nav)"

# --- gold ---
CTES.update({
    "g_asof_nav": f"SELECT scheme_code, nav, nav_date AS as_of_date FROM s_nav WHERE nav_date = {AS_OF}",
    "g_fhd": """
SELECT h.customer_id, h.scheme_code, n.as_of_date, h.units_pledged, n.nav,
  h.units_pledged * n.nav AS collateral_value,
  h.units_pledged * n.nav * s.eligible_ltv_pct / 100e0 AS dp_contrib, h.lien_status
FROM s_holding h JOIN g_asof_nav n ON h.scheme_code = n.scheme_code
JOIN x_scheme s ON h.scheme_code = s.scheme_code""",
    "g_by_cust": f"""
SELECT customer_id, {M('collateral_value')} AS collateral_value, {M('dp_contrib')} AS drawing_power
FROM g_fhd GROUP BY customer_id""",
    "g_last_pay": """
SELECT loan_id, max(CAST(paid_at AS TIMESTAMP)) AS last_paid
FROM x_repayment WHERE status = 'SUCCESS' GROUP BY loan_id""",
    "g_fld_base": f"""
SELECT l.loan_id, l.customer_id, {AS_OF} AS as_of_date, l.product_type, l.outstanding,
  coalesce(c.collateral_value, 0e0) AS collateral_value, coalesce(c.drawing_power, 0e0) AS drawing_power,
  l.annual_rate, p.last_paid
FROM s_loan l LEFT JOIN g_last_pay p ON l.loan_id = p.loan_id
LEFT JOIN g_by_cust c ON l.customer_id = c.customer_id""",
    "g_fld_dpd": """
SELECT *, CAST(coalesce(date_diff('day', CAST(last_paid AS DATE), as_of_date), 0) AS INTEGER) AS dpd
FROM g_fld_base""",
    "g_fld": """
SELECT loan_id, customer_id, as_of_date, product_type, outstanding, collateral_value, drawing_power,
  CASE WHEN collateral_value > 0 THEN outstanding / collateral_value * 100 END AS ltv_pct,
  CASE WHEN drawing_power > 0 THEN outstanding / drawing_power * 100 END AS utilization_pct,
  greatest(0e0, outstanding - drawing_power) AS shortfall_amount,
  outstanding > drawing_power AS margin_call_flag,
  dpd,
  CASE WHEN dpd <= 0 THEN 'CURRENT' WHEN dpd <= 30 THEN '1-30' WHEN dpd <= 60 THEN '31-60'
       WHEN dpd <= 90 THEN '61-90' ELSE '90+' END AS npa_bucket,
  outstanding * annual_rate / 100e0 / 365e0 AS accrued_interest, annual_rate
FROM g_fld_dpd""",
    "g_c360_agg": f"""
SELECT customer_id, count(*) AS active_loans, {M('outstanding')} AS total_outstanding,
  {M('collateral_value')} AS total_collateral, max(dpd) AS current_dpd,
  max(CAST(margin_call_flag AS INTEGER)) AS in_margin_call
FROM g_fld GROUP BY customer_id""",
    "g_c360_w": """
SELECT *, CASE WHEN total_collateral > 0 THEN total_outstanding / total_collateral * 100 END AS weighted_ltv
FROM g_c360_agg""",
    "g_c360": """
SELECT *, CASE WHEN current_dpd > 90 OR in_margin_call = 1 THEN 'STRESSED'
               WHEN current_dpd > 0 OR weighted_ltv > 45 THEN 'WATCH' ELSE 'PRIME' END AS segment
FROM g_c360_w""",
    "g_portfolio_agg": f"""
SELECT as_of_date, {M('outstanding')} AS loan_book, {M('collateral_value')} AS aum_pledged,
  {M('drawing_power')} AS total_dp, count(*) AS active_loans
FROM g_fld GROUP BY as_of_date""",
    "g_portfolio": """
SELECT *, loan_book / nullif(aum_pledged, 0) * 100 AS wavg_ltv FROM g_portfolio_agg""",
    "g_risk": f"""
SELECT as_of_date, npa_bucket, count(*) AS loans, {M('outstanding')} AS exposure,
  CAST(sum(CAST(margin_call_flag AS INTEGER)) AS BIGINT) AS margin_calls,
  {M('shortfall_amount')} AS total_shortfall
FROM g_fld GROUP BY as_of_date, npa_bucket""",
    "g_loan_cust": """
SELECT l.loan_id, l.outstanding, l.annual_rate, c.collateral_value, c.drawing_power
FROM s_loan l LEFT JOIN g_by_cust c ON l.customer_id = c.customer_id""",
})

FHD_COLS = "customer_id, scheme_code, as_of_date, units_pledged, nav, collateral_value, dp_contrib, lien_status"

QUERIES: dict[str, str] = {
    # silver
    "tokenize_pii": "SELECT * FROM s_customer",
    "clean_nav": "SELECT * FROM s_nav_clean",
    "latest_nav": "SELECT * FROM s_nav",
    "semi_valid_scheme": "SELECT * FROM s_hold_valid",
    "latest_holding": "SELECT * FROM s_holding",
    "clean_loan": "SELECT * FROM s_loan",
    # gold
    "asof_nav": "SELECT * FROM g_asof_nav",
    "fact_holding_daily": f"SELECT {FHD_COLS} FROM g_fhd",
    "customer_collateral": "SELECT * FROM g_by_cust",
    "last_payment": "SELECT * FROM g_last_pay",
    "fact_loan_daily": "SELECT * FROM g_fld",
    "customer_360": "SELECT customer_id, active_loans, total_outstanding, total_collateral, current_dpd, "
                    "in_margin_call, weighted_ltv, segment FROM g_c360",
    "mart_portfolio_daily": "SELECT * FROM g_portfolio",
    "mart_risk_daily": "SELECT * FROM g_risk",
    # serving
    "dash_portfolio_latest": """
SELECT loan_book, aum_pledged, total_dp, active_loans, wavg_ltv
FROM g_portfolio ORDER BY as_of_date DESC LIMIT 1""",
    "dash_risk_by_bucket": """
SELECT npa_bucket, loans, exposure, margin_calls, total_shortfall
FROM g_risk ORDER BY exposure DESC, npa_bucket""",
    "dash_top_margin_calls": """
SELECT loan_id, customer_id, outstanding, drawing_power, shortfall_amount, ltv_pct
FROM g_fld WHERE margin_call_flag = true
ORDER BY shortfall_amount DESC, loan_id LIMIT 50""",
    "dash_ltv_histogram": """
SELECT CAST(floor(ltv_pct / 10) * 10 AS INTEGER) AS ltv_bucket, count(*) AS loans
FROM g_fld WHERE ltv_pct IS NOT NULL GROUP BY 1 ORDER BY 1""",
    "dash_amc_exposure": f"""
SELECT s.amc, {M('h.collateral_value')} AS exposure
FROM g_fhd h JOIN x_scheme s ON h.scheme_code = s.scheme_code
GROUP BY s.amc ORDER BY exposure DESC, s.amc LIMIT 10""",
    "dash_segments": f"""
SELECT segment, count(*) AS customers, {M('total_outstanding')} AS outstanding
FROM g_c360 GROUP BY segment ORDER BY customers DESC, segment""",
    "bi_kpis": """
SELECT (SELECT CAST(sum(CAST(loan_book AS DECIMAL(38,6))) AS DOUBLE) FROM g_portfolio) AS total_loan_book,
       (SELECT CAST(sum(CAST(aum_pledged AS DECIMAL(38,6))) AS DOUBLE) FROM g_portfolio) AS aum_pledged,
       (SELECT CAST(coalesce(sum(active_loans), 0) AS BIGINT) FROM g_portfolio) AS active_loans,
       (SELECT CAST(coalesce(sum(margin_calls), 0) AS BIGINT) FROM g_risk) AS open_margin_calls""",
    "bi_exposure_by_bucket": f"""
SELECT npa_bucket, {M('exposure')} AS exposure FROM g_risk GROUP BY npa_bucket ORDER BY npa_bucket LIMIT 50""",
    "chart_query": """
SELECT segment, count(*) AS customers FROM g_c360 GROUP BY segment""",
    # valuation functions over real rows
    "val_drawing_power": """
SELECT h.holding_id, h.units_pledged, n.nav, s.eligible_ltv_pct,
  h.units_pledged * n.nav * s.eligible_ltv_pct / 100e0 AS drawing_power
FROM s_holding h JOIN g_asof_nav n ON h.scheme_code = n.scheme_code
JOIN x_scheme s ON h.scheme_code = s.scheme_code""",
    "val_ltv_pct": """
SELECT loan_id, outstanding, collateral_value,
  CASE WHEN collateral_value > 0 THEN outstanding / collateral_value * 100 END AS ltv_pct
FROM g_loan_cust""",
    "val_utilization_pct": """
SELECT loan_id, outstanding, drawing_power,
  CASE WHEN drawing_power > 0 THEN outstanding / drawing_power * 100 END AS utilization_pct
FROM g_loan_cust""",
    "val_shortfall": """
SELECT loan_id, outstanding, drawing_power,
  CASE WHEN drawing_power IS NULL THEN 0e0 ELSE greatest(0e0, outstanding - drawing_power) END AS shortfall
FROM g_loan_cust""",
    "val_margin_call": """
SELECT loan_id, outstanding, drawing_power, outstanding > drawing_power AS margin_call
FROM g_loan_cust""",
    "val_npa_bucket": """
SELECT loan_id, dpd,
  CASE WHEN dpd <= 0 THEN 'CURRENT' WHEN dpd <= 30 THEN '1-30' WHEN dpd <= 60 THEN '31-60'
       WHEN dpd <= 90 THEN '61-90' ELSE '90+' END AS npa_bucket
FROM g_fld_dpd""",
    "val_daily_interest": """
SELECT loan_id, outstanding, annual_rate, outstanding * annual_rate / 100e0 / 365e0 AS daily_interest
FROM s_loan""",
}


def _deps(sql: str) -> list[str]:
    return [name for name in CTES if re.search(rf"\b{re.escape(name)}\b", sql)]


def sql_for(body: str) -> str:
    """Prefix ``body`` with the CTEs it (transitively) references."""
    order: list[str] = []

    def visit(name: str, stack: tuple[str, ...] = ()) -> None:
        if name in order:
            return
        for d in _deps(CTES[name]):
            if d != name and d not in stack:
                visit(d, stack + (name,))
        order.append(name)

    for name in _deps(body):
        visit(name)
    if not order:
        return body.strip()
    with_clause = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in order)
    return f"WITH {with_clause}\n{body.strip()}"


def with_suffix(suffix: str, given: dict[str, str]) -> dict[str, str]:
    """Copies of the steps that depend on those given, named with a suffix, over the given bodies (which read the originals)."""
    moved = set(given)
    while True:
        more = {n for n, body in CTES.items() if n not in moved and not n.endswith(suffix) and set(_deps(body)) & moved and n.startswith(("s_", "g_"))}
        if not more:
            break
        moved |= more
    name = re.compile(r"\b(" + "|".join(sorted(moved)) + r")\b")
    return {n + suffix: given.get(n) or name.sub(lambda m: m[1] + suffix, CTES[n]) for n in moved}


def oracle_queries() -> dict[str, str]:
    return {k: sql_for(v) for k, v in QUERIES.items()}
