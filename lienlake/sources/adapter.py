"""Present the driver's TPC-H-like tables as the lending source tables.

The mapping rules are fixed by the fixture contract (customer -> borrower,
part -> scheme, lineitem x orders -> pledged holding, orders -> loan,
lineitem -> repayment, part x 5 days -> published NAV).  Each function is a
lazy DataFrame over the parquet scans, so it scales with the inputs and
Catalyst prunes columns / pushes filters through it.

Nation (25 rows) and region (5 rows) are fixed-size reference tables in this
schema at every scale factor, so broadcasting them is size-proven.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored_bytes
from .tables import read_table, table_path

# Fixed values of the fixture contract.
NAV_START_DATE = "2024-01-01"          # day k = 0 of the published NAV series
NAV_DAYS = 5                           # k = 0..4, so the as-of date is 2024-01-05
NAV_PART_BYTES = 1 << 20              # bytes of the part table whose NAVs one task makes
REPAY_ANCHOR_DATE = "2024-01-05"
EQUITY_TYPES = ["SMALL", "MEDIUM"]     # eligible LTV 50
HYBRID_TYPES = ["LARGE", "STANDARD"]   # eligible LTV 60, everything else DEBT at 75


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x_customer: customer_id, full_name, pan, kyc_status, risk_category, city, state."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    j = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey)
    bucket = F.col("c_custkey") % 100
    return j.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.col("c_name").alias("pan"),
        F.when(bucket < 90, "VERIFIED").when(bucket < 97, "PENDING").otherwise("REJECTED").alias("kyc_status"),
        F.when(F.col("c_acctbal") < 0, "HIGH").when(F.col("c_acctbal") < 5000, "MEDIUM")
         .otherwise("LOW").alias("risk_category"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
    )


def _category(p_type):
    return (F.when(p_type.isin(*EQUITY_TYPES), "EQUITY")
            .when(p_type.isin(*HYBRID_TYPES), "HYBRID").otherwise("DEBT"))


def _eligible_ltv(p_type):
    return (F.when(p_type.isin(*EQUITY_TYPES), F.lit(50.0))
            .when(p_type.isin(*HYBRID_TYPES), F.lit(60.0)).otherwise(F.lit(75.0)))


def schemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x_scheme: scheme_code, scheme_name, amc, category, eligible_ltv_pct."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type")
    t = F.col("p_type")
    return p.select(
        F.col("p_partkey").alias("scheme_code"),
        F.col("p_name").alias("scheme_name"),
        F.col("p_brand").alias("amc"),
        _category(t).alias("category"),
        _eligible_ltv(t).alias("eligible_ltv_pct"),
    )


def nav_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x_nav_raw: scheme_code, nav_date, nav, published_at.

    Each scheme publishes one NAV per day for NAV_DAYS days; every tenth scheme
    also has an earlier (23:00) publication to deduplicate; every 97th scheme
    publishes a zero NAV on the last day and has no earlier publication.  The
    day/version fan-out is a generator over a literal array (no join).  A scheme
    is a few bytes of its file and many NAVs, so a task that gets a whole scan
    split would hold millions of them when they are grouped: above NAV_PART_BYTES
    the schemes are dealt out by key first, which the grouping then makes use of.
    """
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_retailprice")
    pieces = -(-stored_bytes(spark, table_path(sf_dir, "part")) // NAV_PART_BYTES)
    if pieces > 1:
        p = p.repartition(max(pieces, int(spark.conf.get("spark.sql.shuffle.partitions"))), "p_partkey")
    grid = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v"))
                     for k in range(NAV_DAYS) for v in (1, 2)])
    x = p.select("p_partkey", "p_retailprice", F.inline(grid))
    key, k, v = F.col("p_partkey"), F.col("k"), F.col("v")
    x = x.filter(((v == 2) | (key % 10 == 0)) & ~((v == 1) & (key % 97 == 0)))
    nav = (F.when(v == 1, F.col("p_retailprice"))
           .when((key % 97 == 0) & (k == NAV_DAYS - 1), F.lit(0.0))
           .otherwise(F.col("p_retailprice") * (1 + ((key * 7 + k * 13) % 21 - 10) / 100.0)))
    return x.select(
        key.alias("scheme_code"),
        F.date_add(F.lit(NAV_START_DATE).cast("date"), k).alias("nav_date"),
        nav.alias("nav"),
        F.when(v == 1, "23:00").otherwise("23:30").alias("published_at"),
    )


def holdings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x_holding_raw: one pledged holding per lineitem, owned by the order's customer.

    holding_id is not unique (the latest-row rule has real work to do).
    Every 20th customer holds nothing, so that loans without collateral occur
    (the left side of the loan join).  Some rows are faulty: an unknown scheme,
    negative or missing units, an unknown lien status.  ``l_orderkey`` is kept: it is
    determined by holding_id (line numbers are 1..7), and the dedup reuses the
    join's partitioning on it.
    """
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey",
                    "l_quantity", "l_returnflag", "l_shipdate", "l_suppkey", "l_extendedprice")
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").filter(F.col("o_custkey") % 20 != 0)
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    flag = F.col("l_returnflag")
    holding = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return j.select(
        holding.alias("holding_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(holding % 211 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey")).alias("scheme_code"),
        F.when(holding % 223 == 0, -F.col("l_quantity")).when(holding % 227 != 0, F.col("l_quantity")).alias("units_pledged"),
        F.when(holding % 229 == 0, "UNKNOWN").when(flag == "N", "REQUESTED").when(flag == "A", "MARKED").otherwise("RELEASED").alias("lien_status"),
        F.col("l_shipdate").cast("date").alias("as_of_date"),
        "l_suppkey", "l_extendedprice", "l_orderkey",
    )


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x_loan: every order is a loan; customers can have several.  Some have a negative or no outstanding."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    return o.select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_custkey").alias("customer_id"),
        F.lit("OD").alias("product_type"),
        F.when(F.col("o_orderkey") % 331 == 0, -F.col("o_totalprice")).when(F.col("o_orderkey") % 337 != 0, F.col("o_totalprice")).alias("outstanding"),
        (F.lit(9.5) + (F.col("o_orderkey") % 9) * 0.5).alias("annual_rate"),
    )


def disbursements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x_disbursement: one per loan; some name a loan that isn't there."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    return o.select(
        (F.col("o_orderkey") * 10 + 1).alias("disbursement_id"),
        F.when(F.col("o_orderkey") % 347 == 0, -F.col("o_orderkey")).otherwise(F.col("o_orderkey")).alias("loan_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").cast("date").alias("disbursed_at"),
        F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("PENDING").alias("status"),
    )


def repayments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x_repayment: one repayment per lineitem; returned lines are FAILED payments.

    Payment dates spread from 99 days before to 60 days after the as-of date.
    """
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice",
                    "l_discount", "l_shipdate", "l_returnflag")
    d = F.col("l_shipdate")
    offset = ((F.year(d) * 372 + F.month(d) * 31 + F.dayofmonth(d)) % 160 - 60).cast("int")
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("repayment_id"),
        F.col("l_orderkey").alias("loan_id"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("amount"),
        F.date_sub(F.lit(REPAY_ANCHOR_DATE).cast("date"), offset).alias("paid_at"),
        F.when(F.col("l_returnflag") == "R", "FAILED").otherwise("SUCCESS").alias("status"),
    )


SOURCES = {
    "customer": customers,
    "scheme": schemes,
    "nav": nav_raw,
    "mf_holding": holdings_raw,
    "loan": loans,
    "disbursement": disbursements,
    "repayment": repayments,
}


def load_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: fn(spark, sf_dir) for name, fn in SOURCES.items()}
