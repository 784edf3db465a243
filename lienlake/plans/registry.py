"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each entry builds a fresh lazy plan over the driver tables in ``sf_dir``.
Column names match the SQL statements in ``oracle.py`` one for one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions import valuation as V
from . import gold, serving, silver
from .lending import LendingModel

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Callable[[LendingModel], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(LendingModel(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


# ---- silver -------------------------------------------------------------
@register("tokenize_pii")
def _q(m):
    return m.silver["customer"]


@register("clean_nav")
def _q(m):
    return silver.clean_nav(m.src["nav"])


@register("latest_nav")
def _q(m):
    return m.silver["nav"]


@register("semi_valid_scheme")
def _q(m):
    return silver.valid_holdings(m.src["mf_holding"], m.silver["scheme"])


@register("latest_holding")
def _q(m):
    return m.silver["mf_holding"]


@register("clean_loan")
def _q(m):
    return m.silver["loan"]


# ---- gold ---------------------------------------------------------------
@register("asof_nav")
def _q(m):
    return gold.asof_nav(m.silver["nav"], m.as_of)


@register("fact_holding_daily")
def _q(m):
    return m.fhd


@register("customer_collateral")
def _q(m):
    return m.by_cust


@register("last_payment")
def _q(m):
    return m.last_pay


@register("fact_loan_daily")
def _q(m):
    return m.fld


@register("customer_360")
def _q(m):
    return m.c360


@register("mart_portfolio_daily")
def _q(m):
    return m.portfolio


@register("mart_risk_daily")
def _q(m):
    return m.risk


# ---- serving ------------------------------------------------------------
@register("dash_portfolio_latest")
def _q(m):
    return serving.dash_portfolio_latest(m.portfolio)


@register("dash_risk_by_bucket")
def _q(m):
    return serving.dash_risk_by_bucket(m.risk, m.as_of)


@register("dash_top_margin_calls")
def _q(m):
    return serving.dash_top_margin_calls(m.fld, m.as_of)


@register("dash_ltv_histogram")
def _q(m):
    return serving.dash_ltv_histogram(m.fld, m.as_of)


@register("dash_amc_exposure")
def _q(m):
    return serving.dash_amc_exposure(m.fhd, m.silver["scheme"], m.as_of)


@register("dash_segments")
def _q(m):
    return serving.dash_segments(m.c360)


@register("bi_kpis")
def _q(m):
    return serving.bi_kpis(m.portfolio, m.risk, m.as_of)


@register("bi_exposure_by_bucket")
def _q(m):
    return serving.bi_exposure_by_bucket(m.risk, m.as_of)


@register("chart_query")
def _q(m):
    """The 'Customers by Segment' pie: group by segment, COUNT(*), row limit 25."""
    return serving.chart_query(m.c360, ["segment"], [("customers", "COUNT(*)")], row_limit=25)


# ---- valuation functions over real rows ----------------------------------
def _loan_cust(m):
    return (m.silver["loan"].select("loan_id", "customer_id", "outstanding", "annual_rate")
            .join(m.by_cust, "customer_id", "left"))


@register("val_drawing_power")
def _q(m):
    priced = gold.asof_nav(m.silver["nav"], m.as_of).join(
        m.silver["scheme"].select("scheme_code", "eligible_ltv_pct"), "scheme_code")
    h = m.silver["mf_holding"].select("holding_id", "scheme_code", "units_pledged")
    return h.join(priced, "scheme_code").select(
        "holding_id", "units_pledged", "nav", "eligible_ltv_pct",
        V.drawing_power("units_pledged", "nav", "eligible_ltv_pct").alias("drawing_power"))


@register("val_ltv_pct")
def _q(m):
    return _loan_cust(m).select("loan_id", "outstanding", "collateral_value",
                                V.ltv_pct("outstanding", "collateral_value").alias("ltv_pct"))


@register("val_utilization_pct")
def _q(m):
    return _loan_cust(m).select("loan_id", "outstanding", "drawing_power",
                                V.utilization_pct("outstanding", "drawing_power").alias("utilization_pct"))


@register("val_shortfall")
def _q(m):
    return _loan_cust(m).select("loan_id", "outstanding", "drawing_power",
                                V.shortfall("outstanding", "drawing_power").alias("shortfall"))


@register("val_margin_call")
def _q(m):
    return _loan_cust(m).select("loan_id", "outstanding", "drawing_power",
                                V.is_margin_call("outstanding", "drawing_power").alias("margin_call"))


@register("val_npa_bucket")
def _q(m):
    l = m.silver["loan"].select("loan_id").join(m.last_pay, "loan_id", "left")
    dpd = V.days_past_due(m.as_of, "last_paid")
    return l.select("loan_id", dpd.alias("dpd")).select("loan_id", "dpd", V.npa_bucket("dpd").alias("npa_bucket"))


@register("val_daily_interest")
def _q(m):
    return m.silver["loan"].select("loan_id", "outstanding", "annual_rate",
                                   V.daily_interest("outstanding", "annual_rate").alias("daily_interest"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which loans are in margin call, and by how much (top 50)."""
    return QUERIES["dash_top_margin_calls"](spark, sf_dir)


__all__ = ["QUERIES", "flagship"]
