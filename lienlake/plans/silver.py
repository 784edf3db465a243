"""Silver layer: typed, filtered, deduplicated, tokenized source tables.

Each function is ``DataFrame(s) -> DataFrame`` over bronze/raw frames; nothing
is collected.  Casts use ``try_cast`` semantics so a bad text value becomes
NULL (and is then dropped by the numeric filters) instead of failing the job
under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.valuation import tokenize
from ..operators.joins import semi_join_valid
from ..operators.latest import latest

PII_COLUMNS = ["pan", "email", "phone"]
HOLDING_ORDER = ["as_of_date", "scheme_code", "l_suppkey", "l_extendedprice"]
HOLDING_CO_KEYS = ["l_orderkey"]


def _try_double(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols if c in df.columns})


def tokenize_pii(customer: DataFrame) -> DataFrame:
    """Add pan_token, drop raw identifiers; full_name is kept."""
    out = customer.withColumn("pan_token", tokenize("pan"))
    out = out.drop(*[c for c in PII_COLUMNS if c in out.columns])
    if "dob" in out.columns:
        out = out.withColumn("dob", F.col("dob").try_cast("date"))
    return out


def clean_scheme(scheme: DataFrame) -> DataFrame:
    return _try_double(scheme, "eligible_ltv_pct")


def clean_nav(nav: DataFrame) -> DataFrame:
    """Positive NAV only (NULL fails the filter); nav_date as DATE."""
    out = _try_double(nav, "nav").filter(F.col("nav") > 0)
    return out.withColumn("nav_date", F.col("nav_date").try_cast("date"))


def latest_nav(nav_clean: DataFrame) -> DataFrame:
    """One NAV per (scheme, day): the latest publication."""
    return latest(nav_clean, ["scheme_code", "nav_date"], ["published_at"])


def valid_holdings(holding: DataFrame, scheme: DataFrame) -> DataFrame:
    """P5 + J1: non-negative units, scheme must exist."""
    out = _try_double(holding, "units_pledged").filter(F.col("units_pledged") >= 0)
    return semi_join_valid(out, scheme, "scheme_code")


def latest_holding(holding_valid: DataFrame) -> DataFrame:
    """Latest state per holding_id (total order, see HOLDING_ORDER).

    When the source carries the order key the holding id was built from
    (``l_orderkey``, determined by ``holding_id``), it is added to the grouping:
    the source's join on that key already partitioned the rows, so at scale the
    dedup runs without a second shuffle of the holdings."""
    order = [c for c in HOLDING_ORDER if c in holding_valid.columns]
    return latest(holding_valid, ["holding_id"], order, co_keys=HOLDING_CO_KEYS)


def clean_loan(loan: DataFrame) -> DataFrame:
    out = _try_double(loan, "outstanding", "sanctioned_limit", "annual_rate")
    return out.filter(F.col("outstanding") >= 0)


#: How each silver table comes from the sources (and a cleaned scheme from its source).
TABLES = {
    "customer": lambda src: tokenize_pii(src["customer"]),
    "scheme": lambda src: clean_scheme(src["scheme"]),
    "nav": lambda src: latest_nav(clean_nav(src["nav"])),
    "mf_holding": lambda src: latest_holding(valid_holdings(src["mf_holding"], clean_scheme(src["scheme"]))),
    "loan": lambda src: clean_loan(src["loan"]),
    "disbursement": lambda src: src["disbursement"],
    "repayment": lambda src: src["repayment"],
}


def build_silver(src: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: build(src) for name, build in TABLES.items()}
