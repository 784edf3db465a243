"""Stress revaluation (T9): reprice collateral under NAV shocks.

A scenario maps asset category -> NAV multiplier (``"*"`` = any category).
Plan: one aggregation over the holdings computes every scenario's drawing
power per customer at once (one column per scenario: no fan-out of holdings,
no second aggregation).  The loan fact is joined on ``customer_id`` alone, so
its existing customer partitioning is reused, and only then is each loan
expanded into one row per scenario with a generator over a literal array
whose length is the caller's scenario count.  No join against a scenario
table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import valuation as V

# Fixed value: the reference scenario (a 12% NAV drop).
DEFAULT_SCENARIOS: dict[str, dict[str, float]] = {"nav_down_12": {"*": 0.88}}


def _factor(shocks: Mapping[str, float]):
    default = F.lit(float(shocks.get("*", 1.0)))
    expr = None
    for cat, f in shocks.items():
        if cat == "*":
            continue
        cond = F.col("category") == cat
        expr = (F.when(cond, F.lit(float(f))) if expr is None else expr.when(cond, F.lit(float(f))))
    return default if expr is None else expr.otherwise(default)


def stressed_drawing_power(fhd: DataFrame, scheme: DataFrame,
                           scenarios: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """(customer_id, _dp0, _dp1, ...): drawing power under each scenario."""
    cats = scheme.select("scheme_code", "category")
    h = fhd.select("customer_id", "scheme_code", "dp_contrib").join(cats, "scheme_code")
    return h.groupBy("customer_id").agg(*[
        V.money_sum(F.col("dp_contrib") * _factor(sh)).alias(f"_dp{i}")
        for i, sh in enumerate(scenarios.values())])


def stress_revalue(fld: DataFrame, fhd: DataFrame, scheme: DataFrame,
                   scenarios: Mapping[str, Mapping[str, float]] | None = None,
                   only_new_calls: bool = True) -> DataFrame:
    """Loans whose margin status changes under each scenario.

    Output: scenario, loan_id, customer_id, outstanding, base_drawing_power,
    stressed_drawing_power, shortfall, margin_call, newly_breached.
    """
    scenarios = scenarios or DEFAULT_SCENARIOS
    sdp = stressed_drawing_power(fhd, scheme, scenarios)
    loans = fld.select("loan_id", "customer_id", "outstanding",
                       F.col("drawing_power").alias("base_drawing_power"),
                       F.col("margin_call_flag").alias("base_margin_call"))
    j = loans.join(sdp, "customer_id", "left")
    grid = F.array(*[F.struct(F.lit(name).alias("scenario"),
                              F.coalesce(F.col(f"_dp{i}"), F.lit(0.0)).alias("stressed_drawing_power"))
                     for i, name in enumerate(scenarios)])
    per = j.select("loan_id", "customer_id", "outstanding", "base_drawing_power", "base_margin_call",
                   F.inline(grid))
    dp = F.col("stressed_drawing_power")
    out = per.select(
        "scenario", "loan_id", "customer_id", "outstanding", "base_drawing_power", "stressed_drawing_power",
        V.shortfall("outstanding", dp).alias("shortfall"),
        V.is_margin_call("outstanding", dp).alias("margin_call"),
        (V.is_margin_call("outstanding", dp) & ~F.col("base_margin_call")).alias("newly_breached"))
    return out.filter(F.col("newly_breached")) if only_new_calls else out
