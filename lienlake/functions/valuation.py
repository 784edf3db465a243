"""Valuation and risk formulas as Column functions (JVM-side, codegen'd).

Every function takes and returns ``Column`` so the same formula is used in
batch facts, streaming state inputs, stress scenarios and tests.  Arithmetic
order follows the gold layer: ``units * nav * ltv / 100.0``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's results.
NPA_BUCKETS = ["CURRENT", "1-30", "31-60", "61-90", "90+"]   # upper edges 0, 30, 60, 90 (inclusive)
SEGMENTS = ["STRESSED", "WATCH", "PRIME"]                    # evaluated in this order
WATCH_LTV_PCT = 45          # weighted LTV above this puts a customer on WATCH
STRESSED_DPD = 90           # DPD above this is STRESSED
DEFAULT_LTV_PCT = 50.0      # eligible LTV for a scheme the stream does not know
DAYS_PER_YEAR = 365.0


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def collateral_value(units, nav) -> Column:
    return _c(units) * _c(nav)


def drawing_power(units, nav, ltv_pct) -> Column:
    """V1: units x NAV x eligible LTV% (gold order: value * ltv / 100)."""
    return collateral_value(units, nav) * _c(ltv_pct) / 100.0


def ltv_pct(outstanding, collateral) -> Column:
    """V2: outstanding / collateral * 100; NULL when collateral <= 0 or NULL."""
    col = _c(collateral)
    return F.when(col > 0, _c(outstanding) / col * 100)


def utilization_pct(outstanding, dp) -> Column:
    """V3: outstanding / drawing power * 100; NULL when dp <= 0 or NULL."""
    d = _c(dp)
    return F.when(d > 0, _c(outstanding) / d * 100)


def shortfall(outstanding, dp) -> Column:
    """V4: max(0, outstanding - dp).  ``greatest`` skips NULL operands."""
    return F.greatest(F.lit(0.0), _c(outstanding) - _c(dp))


def is_margin_call(outstanding, dp) -> Column:
    """V5: strict breach."""
    return _c(outstanding) > _c(dp)


def npa_bucket(dpd) -> Column:
    """V6: inclusive upper edges."""
    d = _c(dpd)
    return (F.when(d <= 0, NPA_BUCKETS[0])
            .when(d <= 30, NPA_BUCKETS[1])
            .when(d <= 60, NPA_BUCKETS[2])
            .when(d <= 90, NPA_BUCKETS[3])
            .otherwise(NPA_BUCKETS[4]))


def daily_interest(outstanding, annual_rate_pct) -> Column:
    """V7: outstanding * rate / 100 / 365 (gold order)."""
    return _c(outstanding) * _c(annual_rate_pct) / 100.0 / DAYS_PER_YEAR


def days_past_due(as_of, last_paid) -> Column:
    """days since last successful payment; never paid -> 0 (may be negative)."""
    return F.coalesce(F.datediff(_c(as_of), F.to_date(_c(last_paid))), F.lit(0))


def segment(current_dpd, in_margin_call, weighted_ltv) -> Column:
    """V8: STRESSED, then WATCH, else PRIME; NULL comparisons fall through."""
    return (F.when((_c(current_dpd) > STRESSED_DPD) | (_c(in_margin_call) == 1), SEGMENTS[0])
            .when((_c(current_dpd) > 0) | (_c(weighted_ltv) > WATCH_LTV_PCT), SEGMENTS[1])
            .otherwise(SEGMENTS[2]))


def tokenize(col, salt: str | None = None) -> Column:
    """irreversible token of a personal identifier: sha256(upper(x))."""
    v = F.upper(_c(col))
    if salt:
        v = F.concat(F.lit(salt), v)
    return F.sha2(v, 256)


def change_hash(*cols) -> Column:
    """sha256 over '|'-joined attributes (NULLs are skipped by concat_ws)."""
    return F.sha2(F.concat_ws("|", *[_c(c) for c in cols]), 256)


# Money aggregation.  Double sums depend on summation order, so two runs (or
# two engines) can disagree in the last bits.  Money totals are summed exactly:
# every value becomes an integer count of 1e-8 units (``rint(x * 1e8)``; the
# values here carry at most 6 decimals, so the product is within rounding noise
# of an integer), the counts are summed as DECIMAL(38,0) (long-backed while
# they fit in 18 digits, so no per-row BigDecimal), and the total is scaled
# back once per group and returned as DOUBLE rounded to MONEY_SCALE places.
SUM_SCALE = 8
MONEY_SCALE = 6
_LONG_SAFE = 9.0e10          # |x| * 1e8 stays inside a long below this


def money_units(col) -> Column:
    x = _c(col)
    scaled = F.rint(x * float(10 ** SUM_SCALE))
    return (F.when(F.abs(x) < _LONG_SAFE, scaled.cast("long").cast("decimal(38,0)"))
            .otherwise(scaled.cast("decimal(38,0)")))


def money_total(units_sum) -> Column:
    """Exact decimal(38,0) count of 1e-8 units -> DOUBLE rounded to MONEY_SCALE."""
    scaled = _c(units_sum) / F.lit(10 ** SUM_SCALE).cast("decimal(38,0)")
    return F.round(scaled, MONEY_SCALE).cast(f"decimal(38,{MONEY_SCALE})").cast("double")


def money_sum(col) -> Column:
    return money_total(F.sum(money_units(col)))
