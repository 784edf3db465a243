"""Serving queries over tables that keep history: only the latest day counts."""

import datetime as dt

import pytest

from lienlake.plans import serving

D1, D2 = dt.date(2024, 1, 4), dt.date(2024, 1, 5)


@pytest.fixture(scope="module")
def risk(spark):
    rows = [(D1, "0", 1, 10.0, 1, 1.0), (D2, "0", 1, 10.0, 0, 0.0), (D1, "30+", 2, 5.0, 2, 3.0)]
    return spark.createDataFrame(rows, "as_of_date date, npa_bucket string, loans long, exposure double, margin_calls long, "
                                       "total_shortfall double")


@pytest.fixture(scope="module")
def loans(spark):
    rows = [(D1, 1, 7, 10.0, 5.0, 5.0, 55.0, True), (D2, 1, 7, 10.0, 20.0, 0.0, 25.0, False), (D2, 2, 8, 30.0, 20.0, 10.0, 95.0, True)]
    return spark.createDataFrame(rows, "as_of_date date, loan_id long, customer_id long, outstanding double, drawing_power double, "
                                       "shortfall_amount double, ltv_pct double, margin_call_flag boolean")


def test_exposure_by_bucket_counts_one_day(risk):
    assert [tuple(r) for r in serving.bi_exposure_by_bucket(risk).collect()] == [("0", 10.0)]


def test_risk_by_bucket_lists_one_day(risk):
    assert [r["npa_bucket"] for r in serving.dash_risk_by_bucket(risk).collect()] == ["0"]
    assert serving.risk_table(risk, row_limit=0).count() == 0


def test_margin_calls_and_histogram_of_the_latest_day(loans):
    assert [r["loan_id"] for r in serving.dash_top_margin_calls(loans).collect()] == [2]
    assert {r["ltv_bucket"]: r["loans"] for r in serving.dash_ltv_histogram(loans).collect()} == {20: 1, 90: 1}


def test_exposure_by_fund_house_of_the_latest_day(spark):
    held = spark.createDataFrame([(D1, "a", 7.0), (D2, "a", 3.0)], "as_of_date date, scheme_code string, collateral_value double")
    scheme = spark.createDataFrame([("a", "house")], "scheme_code string, amc string")
    assert [tuple(r) for r in serving.dash_amc_exposure(held, scheme).collect()] == [("house", 3.0)]
