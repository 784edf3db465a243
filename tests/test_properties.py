"""Property checks against brute force on random small inputs."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lienlake.functions import valuation as V
from lienlake.operators import scd2
from lienlake.operators.latest import latest

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(
    st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 3),
              st.sampled_from(["a", "b", "c"])),
    min_size=1, max_size=30)


@SETTINGS
@given(rows=rows_strategy)
def test_latest_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, o int, p int, s string").repartition(3)
    got = sorted(tuple(r) for r in latest(df, ["k"], ["o", "p"]).collect())

    def rank(r):   # descending on o, p, then the rest; NULL lowest
        return tuple((v is not None, v if v is not None else 0) for v in (r[1], r[2], r[3]))
    want = {}
    for r in rows:
        if r[0] not in want or rank(r) > rank(want[r[0]]):
            want[r[0]] = r
    assert got == sorted(want.values())


@SETTINGS
@given(vals=st.lists(st.integers(-10**12, 10**12), min_size=1, max_size=40), parts=st.integers(1, 5))
def test_money_sum_exact_under_any_partitioning(spark, vals, parts):
    # values with at most 6 decimals, as produced by the valuation formulas
    xs = [v / 10**6 for v in vals]
    df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(parts)
    got = df.agg(V.money_sum("x").alias("s")).first()["s"]
    assert got == float(sum(Decimal(v) for v in vals) / Decimal(10**6))


stage_strategy = st.dictionaries(st.integers(0, 6), st.sampled_from(["A", "B", "C"]), max_size=7)


@SETTINGS
@given(runs=st.lists(stage_strategy, min_size=1, max_size=4))
def test_scd2_one_current_row_per_key(spark, runs):
    def stage(d):
        return spark.createDataFrame([(k, v, v) for k, v in d.items()] or [], "customer_id int, kyc string, _hash string")
    dim = scd2.scd2_initial(stage(runs[0]), "2024-01-01")
    seen = dict(runs[0])
    for day, d in enumerate(runs[1:], start=2):
        dim = scd2.scd2_apply(dim, stage(d), f"2024-01-0{day}")
        seen.update(d)
    rows = dim.collect()
    current = {r["customer_id"]: r["kyc"] for r in rows if r["is_current"]}
    # every key ever seen has exactly one current row, holding its latest value
    assert sorted(r["customer_id"] for r in rows if r["is_current"]) == sorted(seen)
    assert current == seen
    # closed rows always have an end date; current rows never do
    assert all((r["scd_valid_to"] is None) == r["is_current"] for r in rows)
