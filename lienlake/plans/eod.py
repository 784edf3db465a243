"""End-of-day run (T10): bronze -> silver -> gate -> gold -> gate.

One application, tables as the hand-over between layers: each layer is
published and the next layer reads the *published* version, which cuts the
lineage (a lost executor recomputes from the last written table, not from
the raw files) and replaces the reference's fourfold recomputation of the
loan fact by one read of its as-of partition.

The gates' checks are counted while their tables are written, without a scan
of their own.  A table with a hard failure is not published, and
``DataQualityError`` is raised, so nothing downstream of it is; the report and
its summary (score, hard failures, JSON) are part of the result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..sinks.publish import Lake, table_counts
from ..sources import adapter
from ..sources.files import stamp_lineage
from . import gold, silver

GOLD_TABLES = ["dim_customer", "dim_scheme", "fact_holding_daily", "fact_loan_daily",
               "customer_360", "mart_portfolio_daily", "mart_risk_daily"]
SNAPSHOT_TABLES = {"fact_holding_daily", "fact_loan_daily", "mart_portfolio_daily", "mart_risk_daily"}


# Independent tables of one layer are written as concurrent Spark jobs from
# driver threads; the cluster scheduler interleaves their tasks.
PARALLEL_WRITES = 4


def run_parallel(tasks: dict, workers: int = PARALLEL_WRITES) -> dict:
    """Run independent publish callables concurrently; re-raise the first failure."""
    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(tasks)))) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


@dataclass
class EodResult:
    as_of: dt.date
    silver_report: list[dict] = field(default_factory=list)
    gold_report: list[dict] = field(default_factory=list)

    def report(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.silver_report + self.gold_report, quality.REPORT_SCHEMA)


def land_bronze(spark: SparkSession, sf_dir: str, lake: Lake, ingested_at: dt.datetime | None = None,
                sources: Mapping[str, DataFrame] | None = None) -> dict[str, str]:
    """Every source table, stamped with lineage, published to bronze.  ``sources`` replace the adapter's."""
    srcs = {**adapter.load_sources(spark, sf_dir), **(sources or {})}
    return run_parallel({
        name: (lambda name=name, df=df: lake.publish_replace(
            stamp_lineage(df, f"driver/{name}", ingested_at), "bronze", name))
        for name, df in srcs.items()})


def _gated(lake: Lake, df: DataFrame, layer: str, name: str, snapshot: bool = False) -> list[dict]:
    return lake.publish_checked(df, layer, name, quality.SUITES[layer].get(name, []), snapshot)


def build_silver_layer(lake: Lake) -> tuple[dict[str, DataFrame], list[dict]]:
    bronze = {name: lake.read("bronze", name) for name in adapter.SOURCES}
    frames = silver.build_silver(bronze)
    reports = run_parallel({name: (lambda name=name, df=df: _gated(lake, df, "silver", name)) for name, df in frames.items()})
    report = quality.enforce([r for rows in reports.values() for r in rows])
    return {name: lake.read("silver", name) for name in frames}, report


def build_gold_layer(lake: Lake, sil: dict[str, DataFrame], run_date: dt.date) -> tuple[dt.date, list[dict]]:
    stage = gold.dim_customer_stage(sil["customer"])
    # This run's own valuation date: the newest NAV that it landed (one aggregate
    # over one column), whatever days the history already has.
    as_of_value = sil["nav"].agg(F.max("nav_date")).first()[0]
    if as_of_value is None:
        raise ValueError("no NAV to value the holdings at")
    as_of = F.lit(as_of_value)
    fhd = gold.fact_holding_daily(sil["mf_holding"], sil["nav"], sil["scheme"], as_of)
    run_parallel({
        "dim_customer": lambda: lake.scd2("gold", "dim_customer").apply(stage, run_date),
        "dim_scheme": lambda: lake.publish_replace(sil["scheme"], "gold", "dim_scheme"),
        "fact_holding_daily": lambda: lake.publish_snapshot(fhd, "gold", "fact_holding_daily"),
    })
    fhd_pub = lake.read_snapshot("gold", "fact_holding_daily", as_of_value)
    fld = gold.fact_loan_daily(sil["loan"], gold.customer_collateral(fhd_pub),
                               gold.last_payment(sil["repayment"]), F.lit(as_of_value))
    report = quality.enforce(_gated(lake, fld, "gold", "fact_loan_daily", snapshot=True))
    fld_pub = lake.read_snapshot("gold", "fact_loan_daily", as_of_value)
    done = run_parallel({
        "customer_360": lambda: _gated(lake, gold.customer_360(fld_pub), "gold", "customer_360"),
        "mart_portfolio_daily": lambda: lake.publish_snapshot(
            gold.mart_portfolio_daily(fld_pub), "gold", "mart_portfolio_daily"),
        "mart_risk_daily": lambda: lake.publish_snapshot(gold.mart_risk_daily(fld_pub), "gold", "mart_risk_daily"),
    })
    return as_of_value, report + quality.enforce(done["customer_360"])


def read_gold(lake: Lake, as_of) -> dict[str, DataFrame]:
    return {t: (lake.scd2("gold", t).read() if t == "dim_customer" else lake.read_snapshot("gold", t, as_of) if t in SNAPSHOT_TABLES else lake.read("gold", t))
            for t in GOLD_TABLES}


def run_eod(spark: SparkSession, sf_dir: str, lake: Lake | None = None, *, run_date: dt.date | str,
            ingested_at: dt.datetime | None = None, sources: Mapping[str, DataFrame] | None = None) -> EodResult:
    lake = lake or Lake(spark)
    lake.autoflush = False
    run_date = dt.date.fromisoformat(run_date) if isinstance(run_date, str) else run_date
    try:
        land_bronze(spark, sf_dir, lake, ingested_at, sources)
        sil, silver_report = build_silver_layer(lake)
        as_of, gold_report = build_gold_layer(lake, sil, run_date)
    finally:
        lake.flush_audit()
    return EodResult(as_of, silver_report, gold_report)


def gold_counts(lake: Lake, as_of) -> DataFrame:
    return table_counts(read_gold(lake, as_of))
