"""Build the whole lazy lending model (sources -> silver -> gold) for one input dir.

``LendingModel`` only wires lazy DataFrames; nothing runs until an action.
Every registered query starts from here, so each one reads the driver
tables and its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..sources import adapter
from . import gold, silver


class _OnDemand(dict):
    """Frames by name, each built when it is first asked for."""

    def __init__(self, build: Callable[[str], DataFrame]):
        super().__init__()
        self.build = build

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.build(name)
        return self[name]


class LendingModel:
    """Lazy frames for one input directory; every query builds its own."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def src(self) -> Mapping[str, DataFrame]:
        return _OnDemand(lambda name: adapter.SOURCES[name](self.spark, self.sf_dir))

    @cached_property
    def silver(self) -> Mapping[str, DataFrame]:
        return _OnDemand(lambda name: silver.TABLES[name](self.src))

    @cached_property
    def as_of(self):
        return gold.as_of_date(silver.clean_nav(self.src["nav"]))

    @cached_property
    def fhd(self) -> DataFrame:
        s = self.silver
        return gold.fact_holding_daily(s["mf_holding"], s["nav"], s["scheme"], self.as_of)

    @cached_property
    def by_cust(self) -> DataFrame:
        return gold.customer_collateral(self.fhd)

    @cached_property
    def last_pay(self) -> DataFrame:
        return gold.last_payment(self.silver["repayment"])

    @cached_property
    def fld(self) -> DataFrame:
        return gold.fact_loan_daily(self.silver["loan"], self.by_cust, self.last_pay, self.as_of)

    @cached_property
    def c360(self) -> DataFrame:
        return gold.customer_360(self.fld)

    @cached_property
    def portfolio(self) -> DataFrame:
        return gold.mart_portfolio_daily(self.fld)

    @cached_property
    def risk(self) -> DataFrame:
        return gold.mart_risk_daily(self.fld)
