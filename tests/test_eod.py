"""End-of-day run (T10): gates stop the run; a rerun of the same day is idempotent."""

import pytest

from lienlake.operators import quality
from lienlake.plans import eod
from lienlake.sinks.publish import Lake

SF = "/root/testdata/sf0.001"


def test_hard_silver_failure_stops_before_gold(spark, scratch, monkeypatch):
    suite = dict(quality.SILVER_SUITE)
    suite["loan"] = suite["loan"] + [("impossible", "outstanding < 0", True)]
    monkeypatch.setitem(quality.SUITES, "silver", suite)
    lake = Lake(spark, scratch)
    with pytest.raises(quality.DataQualityError):
        eod.run_eod(spark, SF, lake, run_date="2024-01-05")
    assert not lake.exists("silver", "loan") and lake.exists("silver", "nav")      # the failed table is withheld
    assert not lake.scd2("gold", "dim_customer").exists()
    # the audit of what was published before the failure is still written
    assert {r["layer"] for r in lake.audit().collect()} == {"bronze", "silver"}


def test_hard_gold_failure_leaves_the_published_day(spark, scratch, monkeypatch):
    lake = Lake(spark, scratch)
    first = eod.run_eod(spark, SF, lake, run_date="2024-01-05")
    before = lake.read_snapshot("gold", "fact_loan_daily", first.as_of).count()
    suite = dict(quality.GOLD_SUITE)
    suite["fact_loan_daily"] = suite["fact_loan_daily"] + [("impossible", "loan_id < 0", True)]
    monkeypatch.setitem(quality.SUITES, "gold", suite)
    with pytest.raises(quality.DataQualityError, match="impossible"):
        eod.run_eod(spark, SF, lake, run_date="2024-01-06")
    assert lake.read_snapshot("gold", "fact_loan_daily", first.as_of).count() == before


def test_gates_are_counted_on_the_write(spark, scratch):
    """The observed report equals the one that scans the published tables."""
    lake = Lake(spark, scratch)
    res = eod.run_eod(spark, SF, lake, run_date="2024-01-05")
    tables = {t: lake.read("silver", t) for t in quality.SILVER_SUITE}
    scanned = quality.run_suite(tables, "silver").collect() + quality.run_suite(eod.read_gold(lake, res.as_of), "gold").collect()
    assert sorted(map(str, res.report(spark).collect())) == sorted(map(str, scanned))
    assert any(r["violations"] for r in res.silver_report)


def test_rerun_same_day_is_idempotent(spark, scratch):
    lake = Lake(spark, scratch)
    first = eod.run_eod(spark, SF, lake, run_date="2024-01-05")
    counts1 = {r["table_name"]: r["row_count"] for r in eod.gold_counts(lake, first.as_of).collect()}
    second = eod.run_eod(spark, SF, lake, run_date="2024-01-05")
    counts2 = {r["table_name"]: r["row_count"] for r in eod.gold_counts(lake, second.as_of).collect()}
    assert first.as_of == second.as_of
    assert counts1 == counts2                       # SCD2 no-op, snapshots replaced not appended
    assert all(r["passed"] or not r["hard"] for r in second.silver_report + second.gold_report)
    assert lake.read_snapshot("gold", "fact_loan_daily").count() == counts1["fact_loan_daily"]
