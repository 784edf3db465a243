"""Registered queries that publish or read back tables, SCD2, stress and the
end-of-day run.  Writers use a fresh lake root under the shared storage root
for every call, so repeated or concurrent calls cannot see each other's
tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality, scd2, stress
from ..session import scratch_path
from ..sinks.publish import Lake, table_counts
from ..sources import adapter, files
from . import eod, gold
from .lending import LendingModel

QUERIES = {}
ORACLE_SQL = {}

# Fixed values of the fixture contract for the SCD2 runs.
SCD2_FIRST_RUN = "2024-01-01"
SCD2_SECOND_RUN, SCD2_THIRD_RUN = "2024-01-05", "2024-01-09"
STRESS_SCENARIOS = {
    "nav_down_12": {"*": 0.88},
    "equity_crash": {"EQUITY": 0.70, "HYBRID": 0.85, "*": 0.97},
}

LOAN_SCHEMA = T.StructType([
    T.StructField("loan_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_type", T.StringType()),
    T.StructField("outstanding", T.DoubleType()),
    T.StructField("annual_rate", T.DoubleType()),
])


def _reg(name, sql=None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(LendingModel(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def _lake(m: LendingModel) -> Lake:
    return Lake(m.spark, scratch_path(m.spark, "lake"))


# ---- sources -------------------------------------------------------------
@_reg("scan_csv", "SELECT * FROM x_loan")
def _q(m):
    """Export the loan source as CSV, load it back with a declared schema."""
    path = files.write_csv(m.src["loan"], scratch_path(m.spark, "csv", "loan"))
    return files.read_csv(m.spark, path, LOAN_SCHEMA, mode="FAILFAST")


@_reg("scan_table", "SELECT * FROM x_scheme")
def _q(m):
    """Publish the scheme table and read the current version back."""
    lake = _lake(m)
    lake.publish_replace(m.silver["scheme"], "silver", "scheme")
    return lake.read("silver", "scheme")


@_reg("land_bronze", """
SELECT 'customer' AS table_name, count(*) AS row_count FROM x_customer
UNION ALL SELECT 'scheme', count(*) FROM x_scheme
UNION ALL SELECT 'nav', count(*) FROM x_nav_raw
UNION ALL SELECT 'mf_holding', count(*) FROM x_holding_raw
UNION ALL SELECT 'loan', count(*) FROM x_loan
UNION ALL SELECT 'disbursement', count(*) FROM x_disbursement
UNION ALL SELECT 'repayment', count(*) FROM x_repayment""")
def _q(m):
    """S3: land all sources with lineage; row counts of what was landed."""
    lake = _lake(m)
    eod.land_bronze(m.spark, m.sf_dir, lake)
    return table_counts({name: lake.read("bronze", name) for name in adapter.SOURCES})


# ---- sinks ---------------------------------------------------------------
@_reg("publish_replace", "SELECT * FROM g_fld")
def _q(m):
    """K1: publish twice; the second version replaces the first."""
    lake = _lake(m)
    lake.publish_replace(m.fld, "gold", "fact_loan_daily")
    lake.publish_replace(m.fld, "gold", "fact_loan_daily")
    return lake.read("gold", "fact_loan_daily")


@_reg("publish_snapshot", "SELECT * FROM g_fld")
def _q(m):
    """K3: publishing the same as-of twice leaves one copy of its rows."""
    lake = _lake(m)
    lake.publish_snapshot(m.fld, "gold", "fact_loan_daily")
    lake.publish_snapshot(m.fld, "gold", "fact_loan_daily")
    return lake.read_snapshot("gold", "fact_loan_daily").select(*gold.FLD_COLUMNS)


@_reg("publish_audit", """
SELECT 'gold' AS layer, 'mart_portfolio_daily' AS table_name, CAST(NULL AS DATE) AS as_of_date,
  CAST(count(*) AS BIGINT) AS row_count FROM g_portfolio
UNION ALL
SELECT 'gold', 'mart_risk_daily', (SELECT max(as_of_date) FROM g_risk), CAST(count(*) AS BIGINT) FROM g_risk""")
def _q(m):
    """K9: publish history.  The key returns the deterministic audit facts
    (layer, table, as-of, rows); ``Lake.audit()`` also carries version, commit
    time and path, newest first."""
    lake = _lake(m)
    lake.publish_replace(m.portfolio, "gold", "mart_portfolio_daily")
    lake.publish_snapshot(m.risk, "gold", "mart_risk_daily")
    return lake.audit().select("layer", "table_name", "as_of_date", "row_count")


@_reg("table_counts", """
SELECT 'customer' AS table_name, count(*) AS row_count FROM x_customer
UNION ALL SELECT 'loan', count(*) FROM x_loan
UNION ALL SELECT 'mf_holding', count(*) FROM x_holding_raw""")
def _q(m):
    """Labelled source row counts."""
    return table_counts({"customer": m.src["customer"], "loan": m.src["loan"],
                         "mf_holding": m.src["mf_holding"]})


# ---- SCD2 ----------------------------------------------------------------
def scd2_stages(m: LendingModel):
    """Fixture: run 1 lacks every 50th customer (id % 50 = 49); run 2 has all,
    with KYC forced to PENDING for id % 10 = 0."""
    cust = m.silver["customer"]
    v1 = gold.dim_customer_stage(cust.filter(F.col("customer_id") % 50 != 49))
    v2 = gold.dim_customer_stage(cust.withColumn(
        "kyc_status", F.when(F.col("customer_id") % 10 == 0, F.lit("PENDING")).otherwise(F.col("kyc_status"))))
    return v1, v2


_SCD_CTES = {
    "scd_v1": """
SELECT customer_id, pan_token, kyc_status, risk_category, city, state,
  sha256(concat_ws('|', kyc_status, risk_category, city, state)) AS _hash
FROM s_customer WHERE customer_id % 50 <> 49""",
    "scd_dim1": """
SELECT *, DATE '2024-01-01' AS scd_valid_from, CAST(NULL AS DATE) AS scd_valid_to, true AS is_current
FROM scd_v1""",
    "scd_v2_attrs": """
SELECT customer_id, pan_token, CASE WHEN customer_id % 10 = 0 THEN 'PENDING' ELSE kyc_status END AS kyc_status,
  risk_category, city, state FROM s_customer""",
    "scd_v2": """
SELECT *, sha256(concat_ws('|', kyc_status, risk_category, city, state)) AS _hash FROM scd_v2_attrs""",
}


@_reg("scd2_initial", "SELECT * FROM scd_dim1")
def _q(m):
    v1, _ = scd2_stages(m)
    return scd2.scd2_initial(v1, SCD2_FIRST_RUN)


@_reg("scd2_customer", """
SELECT t.customer_id, t.pan_token, t.kyc_status, t.risk_category, t.city, t.state, t._hash, t.scd_valid_from,
  CASE WHEN s.customer_id IS NOT NULL AND s._hash <> t._hash THEN DATE '2024-01-05' ELSE t.scd_valid_to END AS scd_valid_to,
  CASE WHEN s.customer_id IS NOT NULL AND s._hash <> t._hash THEN false ELSE t.is_current END AS is_current
FROM scd_dim1 t LEFT JOIN scd_v2 s ON t.customer_id = s.customer_id
UNION ALL
SELECT s.customer_id, s.pan_token, s.kyc_status, s.risk_category, s.city, s.state, s._hash,
  DATE '2024-01-05' AS scd_valid_from, CAST(NULL AS DATE) AS scd_valid_to, true AS is_current
FROM scd_v2 s LEFT JOIN scd_dim1 t ON t.customer_id = s.customer_id
WHERE t.customer_id IS NULL OR t._hash <> s._hash""")
def _q(m):
    v1, v2 = scd2_stages(m)
    dim1 = scd2.scd2_initial(v1, SCD2_FIRST_RUN)
    return scd2.scd2_apply(dim1, v2, SCD2_SECOND_RUN)


def _merged(dim: str, stage: str, day: str) -> str:
    return f"""
SELECT t.customer_id, t.pan_token, t.kyc_status, t.risk_category, t.city, t.state, t._hash, t.scd_valid_from,
  CASE WHEN s._hash <> t._hash THEN DATE '{day}' ELSE t.scd_valid_to END AS scd_valid_to, coalesce(s._hash = t._hash, true) AND t.is_current AS is_current
FROM {dim} t LEFT JOIN {stage} s ON t.customer_id = s.customer_id AND t.is_current
UNION ALL
SELECT s.customer_id, s.pan_token, s.kyc_status, s.risk_category, s.city, s.state, s._hash, DATE '{day}', CAST(NULL AS DATE), true
FROM {stage} s LEFT JOIN {dim} t ON t.customer_id = s.customer_id AND t.is_current WHERE t.customer_id IS NULL OR t._hash <> s._hash"""


@_reg("scd2_runs", "SELECT * FROM scd_dim3")
def _q(m):
    """Three runs into one table, the last of them twice; only changed buckets and the day's closed versions are written."""
    v1, v2 = scd2_stages(m)
    third = m.silver["customer"].withColumn("risk_category", F.when(F.col("customer_id") % 7 == 0, "HIGH").otherwise(F.col("risk_category")))
    v3 = gold.dim_customer_stage(third)
    table = _lake(m).scd2("gold", "dim_customer")
    for stage, day in ((v1, SCD2_FIRST_RUN), (v2, SCD2_SECOND_RUN), (v3, SCD2_THIRD_RUN), (v3, SCD2_THIRD_RUN)):
        table.apply(stage, day)
    return table.read()


# ---- stress --------------------------------------------------------------
@_reg("stress_revalue", f"""
SELECT scenario, loan_id, customer_id, outstanding, base_drawing_power, stressed_drawing_power,
  greatest(0e0, outstanding - stressed_drawing_power) AS shortfall,
  outstanding > stressed_drawing_power AS margin_call,
  outstanding > stressed_drawing_power AND NOT base_margin_call AS newly_breached
FROM (
  SELECT 'nav_down_12' AS scenario, loan_id, customer_id, outstanding, base_drawing_power, base_margin_call,
    coalesce(dp0, 0e0) AS stressed_drawing_power FROM stress_loans
  UNION ALL
  SELECT 'equity_crash', loan_id, customer_id, outstanding, base_drawing_power, base_margin_call,
    coalesce(dp1, 0e0) FROM stress_loans)
WHERE outstanding > stressed_drawing_power AND NOT base_margin_call""")
def _q(m):
    """Loans newly in margin call under each NAV shock scenario."""
    return stress.stress_revalue(m.fld, m.fhd, m.silver["scheme"], STRESS_SCENARIOS)


# ---- end of day ------------------------------------------------------------
@_reg("eod_run", """
SELECT 'dim_customer' AS table_name, count(*) AS row_count FROM s_customer
UNION ALL SELECT 'dim_scheme', count(*) FROM x_scheme
UNION ALL SELECT 'fact_holding_daily', count(*) FROM g_fhd
UNION ALL SELECT 'fact_loan_daily', count(*) FROM g_fld
UNION ALL SELECT 'customer_360', count(*) FROM g_c360
UNION ALL SELECT 'mart_portfolio_daily', count(*) FROM g_portfolio
UNION ALL SELECT 'mart_risk_daily', count(*) FROM g_risk""")
def _q(m):
    """Full run with gates into a fresh lake; row counts of the gold tables."""
    lake = _lake(m)
    res = eod.run_eod(m.spark, m.sf_dir, lake, run_date="2024-01-05")
    return eod.gold_counts(lake, res.as_of)


@_reg("eod_quality", "eod_quality")
def _q(m):
    """The summary documents of a run whose gates are counted while its tables are written."""
    res = eod.run_eod(m.spark, m.sf_dir, _lake(m), run_date="2024-01-05")
    return quality.summary(res.report(m.spark))


def _next_day(m):
    """Fixture: the NAVs of one more day, on which prices fall by 30 %."""
    nav = m.src["nav"]
    last = nav.filter((F.col("nav_date") == "2024-01-05") & (F.col("published_at") == "23:30"))
    return nav.unionByName(last.withColumns({"nav_date": F.date_add("nav_date", 1), "nav": F.col("nav") * 0.7}))


@_reg("eod_two_days", f"SELECT {', '.join(gold.FLD_COLUMNS)} FROM g_fld UNION ALL SELECT {', '.join(gold.FLD_COLUMNS)} FROM g_fld_next")
def _q(m):
    """Two days' runs into one lake, the second with a price drop; both days' loan facts are there."""
    lake = _lake(m)
    eod.run_eod(m.spark, m.sf_dir, lake, run_date="2024-01-05")
    eod.run_eod(m.spark, m.sf_dir, lake, run_date="2024-01-06", sources={"nav": _next_day(m)})
    return lake.read_snapshot("gold", "fact_loan_daily").select(*gold.FLD_COLUMNS)


def _finish():
    from .oracle import CTES, M as _money, sql_for, with_suffix
    from .quality_queries import ORACLE_SQL as QUALITY_SQL
    CTES.update(_SCD_CTES)
    CTES["scd_v3"] = """
SELECT *, sha256(concat_ws('|', kyc_status, risk_category, city, state)) AS _hash FROM (
  SELECT customer_id, pan_token, kyc_status, CASE WHEN customer_id % 7 = 0 THEN 'HIGH' ELSE risk_category END AS risk_category, city, state FROM s_customer)"""
    CTES["scd_dim2"], CTES["scd_dim3"] = _merged("scd_dim1", "scd_v2", SCD2_SECOND_RUN), _merged("scd_dim2", "scd_v3", SCD2_THIRD_RUN)
    CTES.update(with_suffix("_next", {"x_nav_raw": """
SELECT * FROM x_nav_raw UNION ALL
SELECT scheme_code, CAST(nav_date + INTERVAL '1' DAY AS DATE), nav * 0.7e0, published_at FROM x_nav_raw
WHERE nav_date = DATE '2024-01-05' AND published_at = '23:30'"""}))
    CTES["stress_dp"] = f"""
SELECT f.customer_id, {_money('f.dp_contrib * 0.88e0')} AS dp0,
  {_money("f.dp_contrib * CASE WHEN s.category = 'EQUITY' THEN 0.7e0 WHEN s.category = 'HYBRID' THEN 0.85e0 ELSE 0.97e0 END")} AS dp1
FROM g_fhd f JOIN x_scheme s ON f.scheme_code = s.scheme_code GROUP BY f.customer_id"""
    CTES["stress_loans"] = """
SELECT l.loan_id, l.customer_id, l.outstanding, l.drawing_power AS base_drawing_power,
  l.margin_call_flag AS base_margin_call, d.dp0, d.dp1
FROM g_fld l LEFT JOIN stress_dp d ON l.customer_id = d.customer_id"""
    for k, body in list(ORACLE_SQL.items()):
        ORACLE_SQL[k] = sql_for(body)
    ORACLE_SQL["eod_quality"] = QUALITY_SQL["dq_json"]


_finish()
