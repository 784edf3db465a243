"""Serving queries: dashboard SQL and BI tiles.

All take gold frames and return small result frames.  Top-k queries end
with a unique sort key so ties cannot make the result order-dependent; they
plan as TakeOrderedAndProject (per-partition top-k, then a k-row merge),
never a full global sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.valuation import money_sum, money_total, money_units


def latest_as_of(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Rows of the newest as_of_date only: facts and daily marts keep history.
    ``as_of``: that date, if the caller has it (a published table's is read
    from its partition column)."""
    return df.filter(F.col("as_of_date") == (as_of if as_of is not None else df.select(F.max("as_of_date")).scalar()))


def dash_portfolio_latest(mart_portfolio: DataFrame) -> DataFrame:
    """O1: the latest portfolio snapshot row."""
    return (mart_portfolio.orderBy(F.col("as_of_date").desc()).limit(1)
            .select("loan_book", "aum_pledged", "total_dp", "active_loans", "wavg_ltv"))


def dash_risk_by_bucket(mart_risk: DataFrame, as_of: Column | None = None) -> DataFrame:
    """O2: the latest day's risk table by DPD bucket, largest exposure first."""
    return (latest_as_of(mart_risk, as_of).select("npa_bucket", "loans", "exposure", "margin_calls", "total_shortfall")
            .orderBy(F.col("exposure").desc(), F.col("npa_bucket")))


def risk_table(mart_risk: DataFrame, as_of: Column | None = None, row_limit: int = 50) -> DataFrame:
    """The BI table of the same rows, cut at the chart's row limit."""
    return dash_risk_by_bucket(mart_risk, as_of).limit(row_limit)


def dash_top_margin_calls(fld: DataFrame, as_of: Column | None = None, k: int = 50) -> DataFrame:
    """The k loans with the largest shortfall among loans in margin call."""
    return (latest_as_of(fld, as_of).filter(F.col("margin_call_flag"))
            .select("loan_id", "customer_id", "outstanding", "drawing_power", "shortfall_amount", "ltv_pct")
            .orderBy(F.col("shortfall_amount").desc(), F.col("loan_id")).limit(k))


def dash_ltv_histogram(fld: DataFrame, as_of: Column | None = None, width: int = 10) -> DataFrame:
    """Equal-width LTV histogram."""
    bucket = (F.floor(F.col("ltv_pct") / width) * width).cast("int").alias("ltv_bucket")
    return (latest_as_of(fld, as_of).filter(F.col("ltv_pct").isNotNull()).groupBy(bucket)
            .agg(F.count(F.lit(1)).alias("loans")).orderBy("ltv_bucket"))


def dash_amc_exposure(fhd: DataFrame, dim_scheme: DataFrame, as_of: Column | None = None, k: int = 10) -> DataFrame:
    """Collateral by fund house, top k.

    Holdings are pre-aggregated per scheme before the join, so the join sees
    one row per scheme instead of one per holding (a hot scheme costs nothing).
    """
    per_scheme = latest_as_of(fhd, as_of).groupBy("scheme_code").agg(F.sum(money_units("collateral_value")).alias("_v"))
    j = per_scheme.join(dim_scheme.select("scheme_code", "amc"), "scheme_code")
    agg = j.groupBy("amc").agg(F.sum("_v").alias("_v"))
    return (agg.select("amc", money_total("_v").alias("exposure"))
            .orderBy(F.col("exposure").desc(), F.col("amc")).limit(k))


def dash_segments(c360: DataFrame, row_limit: int | None = None) -> DataFrame:
    """Customers and outstanding per segment."""
    out = (c360.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"),
                                         money_sum("total_outstanding").alias("outstanding"))
           .orderBy(F.col("customers").desc(), F.col("segment")))
    return out.limit(row_limit) if row_limit else out


def bi_kpis(mart_portfolio: DataFrame, mart_risk: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The four KPI tiles over the latest as-of (one row).

    The two marts are stacked and folded with one aggregate (no join)."""
    p = latest_as_of(mart_portfolio, as_of).select(
        F.col("loan_book").cast("decimal(38,6)").alias("loan_book"),
        F.col("aum_pledged").cast("decimal(38,6)").alias("aum_pledged"),
        F.col("active_loans").cast("bigint").alias("active_loans"),
        F.lit(None).cast("bigint").alias("margin_calls"))
    r = latest_as_of(mart_risk, as_of).select(
        F.lit(None).cast("decimal(38,6)").alias("loan_book"),
        F.lit(None).cast("decimal(38,6)").alias("aum_pledged"),
        F.lit(None).cast("bigint").alias("active_loans"),
        F.col("margin_calls").cast("bigint").alias("margin_calls"))
    s = p.unionByName(r).agg(
        F.sum("loan_book").alias("loan_book"), F.sum("aum_pledged").alias("aum_pledged"),
        F.sum("active_loans").alias("active_loans"), F.sum("margin_calls").alias("margin_calls"))
    return s.select(F.col("loan_book").cast("double").alias("total_loan_book"),
                    F.col("aum_pledged").cast("double").alias("aum_pledged"),
                    F.coalesce(F.col("active_loans"), F.lit(0)).cast("bigint").alias("active_loans"),
                    F.coalesce(F.col("margin_calls"), F.lit(0)).cast("bigint").alias("open_margin_calls"))


def bi_exposure_by_bucket(mart_risk: DataFrame, as_of: Column | None = None, row_limit: int = 50) -> DataFrame:
    """SUM(exposure) by bucket (bar chart)."""
    return (latest_as_of(mart_risk, as_of).groupBy("npa_bucket").agg(money_sum("exposure").alias("exposure"))
            .orderBy(F.col("npa_bucket")).limit(row_limit))


def chart_query(df: DataFrame, columns: Sequence[str] = (), metrics: Sequence[tuple[str, str]] = (),
                row_limit: int = 1000) -> DataFrame:
    """The generic BI chart query.

    * raw mode: ``columns`` only -> projection + row limit;
    * grouped: ``columns`` + ``metrics`` -> group by columns, SQL metrics;
    * single metric: ``metrics`` only -> one-row aggregate.
    ``metrics`` are (label, SQL aggregate expression) pairs.  Limits are the
    chart's row limit (a feature of the chart, not a cost cap).
    """
    exprs = [F.expr(sql).alias(label) for label, sql in metrics]
    if columns and not exprs:
        out = df.select(*columns)
    elif columns:
        out = df.groupBy(*columns).agg(*exprs)
    else:
        out = df.agg(*exprs)
    return out.limit(row_limit)
