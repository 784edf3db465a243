"""The seven seed CSV files: schema registry, strict load and bronze landing.

Every file is read with its declared schema; there is no inference pass, ids are
text and keep leading zeros.  The header must name the schema's columns in their
order, else the load fails.  A line that doesn't fit (a value of another type,
too few or too many fields) doesn't stop the load: it goes to a table of its
own, ``<name>_rejected``, with the line as it was.  Both carry their lineage:
``_source``, ``_ingested_at`` and the file read, ``_file``.

``sources`` gives the landed tables the names that the silver layer reads, so
the whole pipeline runs from a folder of seed files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.eod import run_parallel
from ..session import remove_dir, scratch_path
from ..sinks.publish import CODEC, Lake
from .files import CORRUPT_COL

# The seed files' columns, and the source table that each file is.
SEEDS = {
    "customers": "customer_id string, full_name string, pan string, email string, phone string, dob date, kyc_status string, kyc_type string, "
                 "risk_category string, city string, state string, pincode string, created_at timestamp_ntz",
    "schemes": "scheme_code string, isin string, scheme_name string, amc string, category string, eligible_ltv_pct double",
    "nav_history": "scheme_code string, isin string, nav double, nav_date date, published_at timestamp",
    "holdings": "holding_id string, customer_id string, folio_number string, scheme_code string, isin string, units_pledged double, "
                "units_total double, rta string, lien_status string, lien_ref string, as_of_date date",
    "loans": "loan_id string, customer_id string, product_type string, sanctioned_limit double, outstanding double, applied_ltv_pct double, "
             "status string, annual_rate double, disbursed_at timestamp_ntz",
    "disbursements": "disbursement_id string, loan_id string, customer_id string, amount double, utr string, disbursed_at timestamp_ntz, status string",
    "repayments": "repayment_id string, loan_id string, customer_id string, amount double, principal_comp double, interest_comp double, "
                  "mode string, paid_at timestamp_ntz, status string",
}
TABLES = {"customers": "customer", "schemes": "scheme", "nav_history": "nav", "holdings": "mf_holding", "loans": "loan",
          "disbursements": "disbursement", "repayments": "repayment"}
LINEAGE = ["_source", "_ingested_at", "_file"]


def columns_of(name: str) -> list[str]:
    return [c.split()[0] for c in SEEDS[name].split(", ")]


def read_seed(spark: SparkSession, folder: str, name: str, ingested_at: dt.datetime | None = None) -> DataFrame:
    """A seed file's lines, typed, with lineage; ``_corrupt_record`` holds a line that doesn't fit."""
    at = F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
    lines = (spark.read.schema(f"{SEEDS[name]}, {CORRUPT_COL} string").option("header", True).option("enforceSchema", False)
             .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COL).csv(f"{folder}/{name}.csv"))
    return lines.withColumns({"_source": F.lit(f"seed/{name}.csv"), "_ingested_at": at, "_file": F.col("_metadata.file_path")})


def land_seeds(spark: SparkSession, folder: str, lake: Lake, ingested_at: dt.datetime | None = None) -> None:
    """Publish every seed file's rows, and the lines that don't fit, to bronze.  The lines are parsed once, with all their
    columns (Spark checks no column that a query leaves out).  The files are independent and land as concurrent jobs."""
    def land(name: str) -> None:
        staged = scratch_path(spark, "lines", name)
        read_seed(spark, folder, name, ingested_at).write.option("compression", CODEC).parquet(staged)
        lines = spark.read.parquet(staged)
        bad = F.col(CORRUPT_COL).isNotNull()
        lake.publish_replace(lines.filter(~bad).drop(CORRUPT_COL), "bronze", name)
        lake.publish_replace(lines.filter(bad).select(columns_of(name)[0], F.col(CORRUPT_COL).alias("line"), *LINEAGE), "bronze", f"{name}_rejected")
        remove_dir(spark, staged)

    run_parallel({name: lambda name=name: land(name) for name in SEEDS})


def sources(lake: Lake) -> dict[str, DataFrame]:
    """The landed seed tables under the names of the source tables."""
    return {table: lake.read("bronze", name).drop(*LINEAGE) for name, table in TABLES.items()}
