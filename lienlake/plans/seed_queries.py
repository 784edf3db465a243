"""Registered queries over seed CSV files.

The fixture writes the adapter's tables as the seven seed files, in the native
column layout, with text ids and with some lines that don't fit their schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks.publish import Lake
from ..sources import seeds
from . import gold, silver
from .eod import run_parallel
from .lending import LendingModel

QUERIES = {}
ORACLE_SQL = {}


def _reg(name, sql):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(LendingModel(spark, sf_dir))
        ORACLE_SQL[name] = sql
        return fn
    return deco


def _id(prefix: str, column: str):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _faulty(column: str, every: int, number: str):
    """The value as text, but no number in one row of ``every``."""
    return F.when(F.col(number) % every == 0, "n/a").otherwise(F.col(column).cast("string"))


def seed_frames(m: LendingModel) -> dict[str, DataFrame]:
    """Fixture: the seed files' lines as text columns."""
    src = m.src
    isin = F.concat(F.lit("INF"), F.col("scheme_code").cast("string"))
    scheme = F.lpad(F.col("scheme_code").cast("string"), 9, "0")
    frames = {
        "customers": src["customer"].select(
            _id("c-", "customer_id").alias("customer_id"), "full_name", "pan", F.concat("full_name", F.lit("@x.in")).alias("email"),
            F.lit("0").alias("phone"), F.when(F.col("customer_id") % 409 == 0, "unknown").otherwise("1990-01-31").alias("dob"), "kyc_status",
            F.lit("CKYC").alias("kyc_type"), "risk_category", "city", "state",
            F.lpad((F.col("customer_id") % 1_000_000).cast("string"), 6, "0").alias("pincode"), F.lit("2023-01-01T10:00:00").alias("created_at")),
        "schemes": src["scheme"].select(scheme.alias("scheme_code"), isin.alias("isin"), "scheme_name", "amc", "category", "eligible_ltv_pct"),
        "nav_history": src["nav"].select(
            scheme.alias("scheme_code"), isin.alias("isin"), _faulty("nav", 419, "scheme_code").alias("nav"), "nav_date",
            F.concat(F.col("nav_date").cast("string"), F.lit("T"), F.col("published_at"), F.lit(":00+05:30")).alias("published_at")),
        "holdings": src["mf_holding"].select(
            _id("h-", "holding_id").alias("holding_id"), _id("c-", "customer_id").alias("customer_id"), F.lit("1/1").alias("folio_number"),
            scheme.alias("scheme_code"), isin.alias("isin"), _faulty("units_pledged", 421, "holding_id").alias("units_pledged"),
            F.col("l_extendedprice").alias("units_total"), F.col("l_suppkey").cast("string").alias("rta"), "lien_status",
            F.lit("LIEN").alias("lien_ref"), "as_of_date"),
        "loans": src["loan"].select(
            _id("l-", "loan_id").alias("loan_id"), _id("c-", "customer_id").alias("customer_id"), "product_type", F.lit(1.0).alias("sanctioned_limit"),
            _faulty("outstanding", 431, "loan_id").alias("outstanding"), F.lit(50.0).alias("applied_ltv_pct"), F.lit("DISBURSED").alias("status"),
            "annual_rate", F.lit("2023-06-01T00:00:00").alias("disbursed_at")),
        "disbursements": src["disbursement"].select(
            _id("d-", "disbursement_id").alias("disbursement_id"), _id("l-", "loan_id").alias("loan_id"), _id("c-", "customer_id").alias("customer_id"),
            _faulty("amount", 433, "disbursement_id").alias("amount"), F.lit("UTR").alias("utr"),
            F.concat(F.col("disbursed_at").cast("string"), F.lit("T00:00:00")).alias("disbursed_at"), "status"),
        "repayments": src["repayment"].select(
            _id("r-", "repayment_id").alias("repayment_id"), _id("l-", "loan_id").alias("loan_id"), F.lit("c-0").alias("customer_id"), "amount",
            F.lit(0.0).alias("principal_comp"), F.lit(0.0).alias("interest_comp"), F.lit("UPI").alias("mode"),
            F.concat(F.col("paid_at").cast("string"), F.when(F.col("repayment_id") % 439 == 0, "x").otherwise("T12:00:00")).alias("paid_at"), "status"),
    }
    return {name: df.select(*seeds.columns_of(name)) for name, df in frames.items()}


#: Lines of a seed file's part: a compressed part is read by one task.
PART_LINES = 1_000_000


def write_seeds(frames: dict[str, DataFrame], folder: str) -> None:
    """The seed files as concurrent jobs, in compressed parts: their text is several times as large as the tables."""
    def write(name: str) -> None:
        frames[name].write.options(header=True, compression="gzip", maxRecordsPerFile=PART_LINES, **{"zlib.compress.level": "BEST_SPEED"}).csv(f"{folder}/{name}.csv")

    run_parallel({name: lambda name=name: write(name) for name in frames})


def _landed(m: LendingModel) -> Lake:
    folder, lake = scratch_path(m.spark, "seeds"), Lake(m.spark, scratch_path(m.spark, "lake"), autoflush=False)
    write_seeds(seed_frames(m), folder)
    seeds.land_seeds(m.spark, folder, lake)
    return lake


@_reg("land_seeds", """
SELECT 'customers' AS table_name, 'seed/customers.csv' AS source, count(*) FILTER (WHERE customer_id % 409 <> 0) AS landed,
  count(*) FILTER (WHERE customer_id % 409 = 0) AS rejected FROM x_customer
UNION ALL SELECT 'schemes', 'seed/schemes.csv', count(*), 0 FROM x_scheme
UNION ALL SELECT 'nav_history', 'seed/nav_history.csv', count(*) FILTER (WHERE scheme_code % 419 <> 0), count(*) FILTER (WHERE scheme_code % 419 = 0) FROM x_nav_raw
UNION ALL SELECT 'holdings', 'seed/holdings.csv', count(*) FILTER (WHERE holding_id % 421 <> 0), count(*) FILTER (WHERE holding_id % 421 = 0) FROM x_holding_raw
UNION ALL SELECT 'loans', 'seed/loans.csv', count(*) FILTER (WHERE loan_id % 431 <> 0), count(*) FILTER (WHERE loan_id % 431 = 0) FROM x_loan
UNION ALL SELECT 'disbursements', 'seed/disbursements.csv', count(*) FILTER (WHERE disbursement_id % 433 <> 0),
  count(*) FILTER (WHERE disbursement_id % 433 = 0) FROM x_disbursement
UNION ALL SELECT 'repayments', 'seed/repayments.csv', count(*) FILTER (WHERE repayment_id % 439 <> 0), count(*) FILTER (WHERE repayment_id % 439 = 0)
FROM x_repayment""")
def _q(m):
    """Rows landed and lines rejected of each of the seven seed files, by their lineage label."""
    lake = _landed(m)
    parts = []
    for name in seeds.SEEDS:
        for part, ok in ((name, 1), (f"{name}_rejected", 0)):
            parts.append(lake.read("bronze", part).filter("_ingested_at is not null and _file is not null").select(
                F.lit(name).alias("table_name"), "_source", F.lit(ok).alias("ok")))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("table_name", F.col("_source").alias("source")).agg(
        F.sum("ok").cast("bigint").alias("landed"), F.sum(1 - F.col("ok")).cast("bigint").alias("rejected"))


@_reg("seed_customers", """
SELECT 'c-' || customer_id AS customer_id, full_name, lpad(CAST(customer_id % 1000000 AS VARCHAR), 6, '0') AS pincode, DATE '1990-01-31' AS dob,
  kyc_status, 'seed/customers.csv' AS _source FROM x_customer WHERE customer_id % 409 <> 0""")
def _q(m):
    """Typed rows with text ids, leading zeros kept, and their lineage."""
    return _landed(m).read("bronze", "customers").select("customer_id", "full_name", "pincode", "dob", "kyc_status", "_source")


@_reg("seed_loan_daily", """
SELECT 'l-' || loan_id AS loan_id, 'c-' || customer_id AS customer_id, as_of_date, outstanding, collateral_value, drawing_power, shortfall_amount,
  margin_call_flag, dpd, npa_bucket FROM g_fld_seed""")
def _q(m):
    """T3 from the seed files: landed, cleaned and valued, with text ids throughout."""
    src = seeds.sources(_landed(m))
    silver_ = silver.build_silver(src)
    as_of = gold.as_of_date(silver_["nav"])
    fhd = gold.fact_holding_daily(silver_["mf_holding"], silver_["nav"], silver_["scheme"], as_of)
    fld = gold.fact_loan_daily(silver_["loan"], gold.customer_collateral(fhd), gold.last_payment(silver_["repayment"]), as_of)
    return fld.select("loan_id", "customer_id", "as_of_date", "outstanding", "collateral_value", "drawing_power", "shortfall_amount",
                      "margin_call_flag", "dpd", "npa_bucket")


def _finish():
    from .oracle import CTES, sql_for, with_suffix
    # The pipeline over the lines that landed; latest holding by the columns that the file has.
    CTES.update(with_suffix("_seed", {
        "x_nav_raw": "SELECT * FROM x_nav_raw WHERE scheme_code % 419 <> 0",
        "x_loan": "SELECT * FROM x_loan WHERE loan_id % 431 <> 0",
        "x_repayment": "SELECT * FROM x_repayment WHERE repayment_id % 439 <> 0",
        "s_holding": """
SELECT holding_id, customer_id, scheme_code, units_pledged, lien_status, as_of_date FROM (
  SELECT *, row_number() OVER (PARTITION BY holding_id ORDER BY as_of_date DESC, lpad(CAST(scheme_code AS VARCHAR), 9, '0') DESC,
    'c-' || customer_id DESC, 'INF' || scheme_code DESC, units_pledged DESC, l_extendedprice DESC, CAST(l_suppkey AS VARCHAR) DESC, lien_status DESC) AS rn
  FROM (SELECT * FROM s_hold_valid WHERE holding_id % 421 <> 0)) WHERE rn = 1"""}))
    for k, body in list(ORACLE_SQL.items()):
        ORACLE_SQL[k] = sql_for(body)


_finish()
