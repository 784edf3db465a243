"""Plan-shape checks: the scale properties the README claims, read from explain()."""

import contextlib
import io

import pytest

from lienlake.plans.lending import LendingModel

SF = "/root/testdata/sf0.001"


def fresh(spark):
    """A model not shared with other tests: a DataFrame keeps the physical plan
    of its first execution, and these checks must plan under their own settings."""
    return LendingModel(spark, SF)


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture()
def no_auto_broadcast(spark):
    """Plan as if every table were large."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_only_nation_and_region_are_forced_to_broadcast(spark, no_auto_broadcast):
    assert "BroadcastHashJoin" not in plan(fresh(spark).fld, "simple")
    assert "SortMergeJoin [scheme_code" in plan(fresh(spark).fhd, "simple")


def test_building_a_query_runs_no_job(spark):
    from lienlake.plans import quality_queries, registry
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    try:
        for build in [*registry.QUERIES.values(), *quality_queries.QUERIES.values()]:
            build(spark, SF)
        jobs = tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


def test_calls_share_no_frames(spark):
    from lienlake.plans.registry import QUERIES
    assert QUERIES["fact_loan_daily"](spark, SF) is not QUERIES["fact_loan_daily"](spark, SF)


def test_as_of_is_a_scalar_subquery_not_a_collect(spark):
    p = plan(fresh(spark).fld)
    assert "Subquery" in p


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(fresh(spark).silver["loan"])
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in p


    p = plan(fresh(spark).silver["nav"].filter("scheme_code = 7"))
    assert "EqualTo(p_partkey,7)" in p


def test_aggregations_are_partial_before_the_shuffle(spark):
    p = plan(fresh(spark).by_cust, "simple")
    assert "partial_sum" in p
