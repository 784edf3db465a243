"""Registered quality-gate queries (D1-D14) and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.constraints import check_constraints
from .lending import LendingModel

QUERIES = {}
ORACLE_SQL = {}


def _reg(name):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(LendingModel(spark, sf_dir))
        return fn
    return deco


def silver_tables(m: LendingModel):
    return {k: m.silver[k] for k in Q.SILVER_SUITE}


def gold_tables(m: LendingModel):
    return {"fact_loan_daily": m.fld, "customer_360": m.c360}


@_reg("dq_silver")
def _q(m):
    return Q.run_suite(silver_tables(m), "silver")


@_reg("dq_gold")
def _q(m):
    return Q.run_suite(gold_tables(m), "gold")


@_reg("dq_score")
def _q(m):
    return Q.score(Q.run_suite(silver_tables(m), "silver").unionByName(Q.run_suite(gold_tables(m), "gold")))


@_reg("dq_columns")
def _q(m):
    return Q.expect_columns_to_match_set(m.silver["nav"], "nav", Q.NAV_COLUMN_SET)


@_reg("dq_not_null")
def _q(m):
    return Q.expect_not_null(m.silver["nav"], "nav", Q.NAV_NOT_NULL)


@_reg("dq_between")
def _q(m):
    return Q.expect_between(m.silver["nav"], "nav", "nav", min_value=0, strict_min=True)


@_reg("dq_unique")
def _q(m):
    return Q.union_all([
        Q.expect_unique(m.silver["nav"], "silver.nav", Q.NAV_KEY),
        Q.expect_unique(m.src["customer"], "source.customer", ["customer_id"]),
        Q.expect_unique(m.src["scheme"], "source.scheme", ["scheme_code"]),
        Q.expect_unique(m.src["mf_holding"], "source.mf_holding", ["holding_id"]),
        Q.expect_unique(m.silver["mf_holding"], "silver.mf_holding", ["holding_id"]),
        Q.expect_unique(m.src["loan"], "source.loan", ["loan_id"]),
    ])


@_reg("dq_foreign_key")
def _q(m):
    s = m.src
    return Q.union_all([
        Q.expect_foreign_key(s["mf_holding"], "mf_holding", "customer_id", s["customer"], "customer", "customer_id"),
        Q.expect_foreign_key(s["mf_holding"], "mf_holding", "scheme_code", s["scheme"], "scheme", "scheme_code"),
        Q.expect_foreign_key(s["loan"], "loan", "customer_id", s["customer"], "customer", "customer_id"),
        Q.expect_foreign_key(s["repayment"], "repayment", "loan_id", s["loan"], "loan", "loan_id"),
    ])


@_reg("dq_constraints")
def _q(m):
    """The six primary and five foreign keys of the source schema."""
    return check_constraints({t: m.src[t] for t in ("customer", "scheme", "mf_holding", "loan", "disbursement", "repayment")})


@_reg("dq_json")
def _q(m):
    """The gates' summary documents."""
    return Q.summary(Q.run_suite(silver_tables(m), "silver").unionByName(Q.run_suite(gold_tables(m), "gold")))


def _broken(m):
    """Fixture: silver tables with faults of each kind; the holdings are the raw ones."""
    k = F.col("customer_id") % 97
    return {
        "nav": m.src["nav"].withColumn("nav_date", F.when(F.col("scheme_code") % 89 != 0, F.col("nav_date"))),
        "customer": m.silver["customer"].withColumns({"pan_token": F.when(k != 1, F.col("pan_token")),
                                                      "kyc_status": F.when(k == 2, "EXPIRED").when(k != 3, F.col("kyc_status"))}),
        "mf_holding": m.src["mf_holding"], "loan": m.src["loan"]}


@_reg("dq_failures")
def _q(m):
    """D1-D5 on faulty tables: hard and soft failures; NULL under a predicate passes."""
    return Q.run_suite(_broken(m), "silver")


# ---- oracle SQL ----------------------------------------------------------
# The gates once more, as SQL over the checked tables.
_GATES = {
    "silver": [("nav", "nav_positive", "nav > 0", True, "s_nav"), ("nav", "nav_date_not_null", "nav_date IS NOT NULL", True, "s_nav"),
               ("customer", "pii_tokenized", "pan_token IS NOT NULL", True, "s_customer"),
               ("customer", "kyc_status_valid", "kyc_status IN ('VERIFIED','PENDING','REJECTED')", True, "s_customer"),
               ("mf_holding", "units_non_negative", "units_pledged >= 0", True, "s_holding"),
               ("mf_holding", "lien_status_valid", "lien_status IN ('REQUESTED','MARKED','RELEASED','INVOKED')", False, "s_holding"),
               ("loan", "outstanding_non_negative", "outstanding >= 0", True, "s_loan")],
    "gold": [("fact_loan_daily", "ltv_cap_or_flagged", "drawing_power <= collateral_value OR collateral_value = 0", True, "g_fld"),
             ("fact_loan_daily", "utilization_sane", "utilization_pct IS NULL OR utilization_pct >= 0", True, "g_fld"),
             ("fact_loan_daily", "npa_bucket_valid", "npa_bucket IN ('CURRENT','1-30','31-60','61-90','90+')", True, "g_fld"),
             ("customer_360", "segment_valid", "segment IN ('PRIME','WATCH','STRESSED')", True, "g_c360")],
}


def _suite_sql(layer: str, tables: dict | None = None) -> str:
    parts = []
    for table, name, pred, hard, source in _GATES[layer]:
        v = f"count(*) FILTER (WHERE NOT ({pred}))"
        parts.append(
            f"SELECT '{layer}' AS layer, '{table}' AS table_name, '{name}' AS expectation, "
            f"{'true' if hard else 'false'} AS hard, CAST(count(*) AS BIGINT) AS total_rows, "
            f"CAST({v} AS BIGINT) AS violations, {v} = 0 AS passed FROM {(tables or {}).get(table, source)}")
    return "\nUNION ALL\n".join(parts)


def _constraint_sql() -> str:
    tables = [("customer", "customer_id"), ("scheme", "scheme_code"), ("mf_holding", "holding_id"), ("loan", "loan_id"),
              ("disbursement", "disbursement_id"), ("repayment", "repayment_id")]
    view = {t: f"x_{t}" for t, _ in tables} | {"mf_holding": "x_holding_raw"}
    parts = [f"SELECT 'primary' AS kind, '{t}' AS table_name, '{c}' AS column_name, CAST(NULL AS VARCHAR) AS parent_table, "
             f"CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_checked, count(*) FILTER (WHERE n > 1 OR {c} IS NULL) AS bad_keys, "
             f"CAST(coalesce(sum(CASE WHEN {c} IS NULL THEN n WHEN n > 1 THEN n - 1 END), 0) AS BIGINT) AS bad_rows, "
             f"count(*) FILTER (WHERE n > 1 OR {c} IS NULL) = 0 AS passed FROM (SELECT {c}, count(*) AS n FROM {view[t]} GROUP BY {c})" for t, c in tables]
    for child, c, parent, p in [("mf_holding", "customer_id", "customer", "customer_id"), ("mf_holding", "scheme_code", "scheme", "scheme_code"),
                                ("loan", "customer_id", "customer", "customer_id"), ("disbursement", "loan_id", "loan", "loan_id"),
                                ("repayment", "loan_id", "loan", "loan_id")]:
        orphan = f"c.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {view[parent]} p WHERE p.{p} = c.{c})"
        parts.append(f"SELECT 'foreign', '{child}', '{c}', '{parent}', (SELECT count(*) FROM {view[child]}), "
                     f"(SELECT count(DISTINCT c.{c}) FROM {view[child]} c WHERE {orphan}), (SELECT count(*) FROM {view[child]} c WHERE {orphan}), "
                     f"(SELECT count(*) FROM {view[child]} c WHERE {orphan}) = 0")
    return "\nUNION ALL\n".join(parts)


def _json_sql(suites: str) -> str:
    return f"""
SELECT layer, CAST(json_object('layer', layer, 'dq_score', round(100e0 * sum(CAST(passed AS INTEGER)) / count(*), 1),
  'hard_failures', count(*) FILTER (WHERE hard AND NOT passed),
  'results', list({{'table': table_name, 'expectation': expectation, 'passed': passed, 'hard': hard}} ORDER BY table_name, expectation)) AS VARCHAR) AS summary
FROM ({suites}) GROUP BY layer"""


def _unique_sql(source: str, label: str, cols: list[str]) -> str:
    k = ", ".join(cols)
    return (f"SELECT '{label}' AS table_name, '{','.join(cols)}' AS key_columns, "
            f"CAST(coalesce(sum(c), 0) AS BIGINT) AS total_rows, "
            f"CAST(count(*) FILTER (WHERE c > 1) AS BIGINT) AS duplicate_keys, "
            f"CAST(coalesce(sum(c - 1) FILTER (WHERE c > 1), 0) AS BIGINT) AS surplus_rows, "
            f"count(*) FILTER (WHERE c > 1) = 0 AS passed "
            f"FROM (SELECT {k}, count(*) AS c FROM {source} GROUP BY {k})")


def _fk_sql(child: str, cname: str, fk: str, parent: str, pname: str, pk: str) -> str:
    return (f"SELECT '{cname}' AS child_table, '{fk}' AS child_column, '{pname}' AS parent_table, "
            f"'{pk}' AS parent_column, CAST(count(DISTINCT c.{fk}) AS BIGINT) AS orphan_keys, "
            f"CAST(count(*) AS BIGINT) AS orphan_rows, count(*) = 0 AS passed "
            f"FROM {child} c WHERE c.{fk} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk})")


def _oracles():
    from .oracle import sql_for
    silver, gold = _suite_sql("silver"), _suite_sql("gold")
    score = f"""
SELECT layer, round(100e0 * sum(CAST(passed AS INTEGER)) / greatest(count(*), 1), 1) AS dq_score,
  CAST(count(*) FILTER (WHERE hard AND NOT passed) AS BIGINT) AS hard_failures, count(*) AS checks
FROM ({silver}
UNION ALL
{gold}) GROUP BY layer"""
    nn = "\nUNION ALL\n".join(
        f"SELECT 'expectation' AS layer, 'nav' AS table_name, 'not_null:{c}' AS expectation, true AS hard, "
        f"CAST(count(*) AS BIGINT) AS total_rows, CAST(count(*) FILTER (WHERE NOT ({c} IS NOT NULL)) AS BIGINT) "
        f"AS violations, count(*) FILTER (WHERE NOT ({c} IS NOT NULL)) = 0 AS passed FROM s_nav"
        for c in ("scheme_code", "nav_date"))
    between = ("SELECT 'expectation' AS layer, 'nav' AS table_name, 'between:nav' AS expectation, true AS hard, "
               "CAST(count(*) AS BIGINT) AS total_rows, CAST(count(*) FILTER (WHERE NOT (nav > 0)) AS BIGINT) "
               "AS violations, count(*) FILTER (WHERE NOT (nav > 0)) = 0 AS passed FROM s_nav")
    unique = "\nUNION ALL\n".join([
        _unique_sql("s_nav", "silver.nav", ["scheme_code", "nav_date"]),
        _unique_sql("x_customer", "source.customer", ["customer_id"]),
        _unique_sql("x_scheme", "source.scheme", ["scheme_code"]),
        _unique_sql("x_holding_raw", "source.mf_holding", ["holding_id"]),
        _unique_sql("s_holding", "silver.mf_holding", ["holding_id"]),
        _unique_sql("x_loan", "source.loan", ["loan_id"]),
    ])
    fk = "\nUNION ALL\n".join([
        _fk_sql("x_holding_raw", "mf_holding", "customer_id", "x_customer", "customer", "customer_id"),
        _fk_sql("x_holding_raw", "mf_holding", "scheme_code", "x_scheme", "scheme", "scheme_code"),
        _fk_sql("x_loan", "loan", "customer_id", "x_customer", "customer", "customer_id"),
        _fk_sql("x_repayment", "repayment", "loan_id", "x_loan", "loan", "loan_id"),
    ])
    want = ", ".join(f"'{c}'" for c in ("scheme_code", "isin", "nav", "nav_date", "published_at"))
    columns = f"""
SELECT 'nav' AS table_name, 'expect_table_columns_to_match_set' AS expectation,
  m.missing = '' AND u.unexpected = '' AS success, m.missing, u.unexpected, n.element_count
FROM (SELECT coalesce(string_agg(w, ',' ORDER BY w), '') AS missing FROM unnest([{want}]) AS t(w)
      WHERE w NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM s_nav))) m,
     (SELECT coalesce(string_agg(column_name, ',' ORDER BY column_name), '') AS unexpected
      FROM (DESCRIBE SELECT * FROM s_nav) WHERE column_name NOT IN ({want})) u,
     (SELECT count(*) AS element_count FROM s_nav) n"""
    k = "customer_id % 97"
    broken = {
        "nav": "(SELECT * REPLACE (CASE WHEN scheme_code % 89 <> 0 THEN nav_date END AS nav_date) FROM x_nav_raw)",
        "customer": f"""(SELECT CASE WHEN {k} <> 1 THEN pan_token END AS pan_token,
            CASE WHEN {k} = 2 THEN 'EXPIRED' WHEN {k} <> 3 THEN kyc_status END AS kyc_status FROM s_customer)""",
        "mf_holding": "x_holding_raw", "loan": "x_loan"}
    return {"dq_constraints": sql_for(_constraint_sql()), "dq_json": sql_for(_json_sql(f"{silver} UNION ALL {gold}")),
            "dq_failures": sql_for(_suite_sql("silver", broken)), "dq_silver": sql_for(silver), "dq_gold": sql_for(gold), "dq_score": sql_for(score),
            "dq_columns": sql_for(columns),
            "dq_not_null": sql_for(nn), "dq_between": sql_for(between),
            "dq_unique": sql_for(unique), "dq_foreign_key": sql_for(fk)}


ORACLE_SQL.update(_oracles())
