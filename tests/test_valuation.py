"""Reference vectors for the valuation formulas, plus edge cases."""

from pyspark.sql import functions as F

from lienlake.functions import valuation as V


def one(spark, col, **cols):
    """Evaluate ``col`` on a one-row frame of double columns."""
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} double" for k in cols))
    return df.select(col.alias("x")).first()["x"]


def test_drawing_power_equity_cap(spark):
    assert one(spark, V.drawing_power("u", "n", "l"), u=100.0, n=200.0, l=50.0) == 10000.0


def test_ltv_pct(spark):
    assert one(spark, V.ltv_pct("o", "c"), o=5000.0, c=10000.0) == 50.0
    assert one(spark, V.ltv_pct("o", "c"), o=5000.0, c=0.0) is None
    assert one(spark, V.ltv_pct("o", "c"), o=5000.0, c=-1.0) is None
    assert one(spark, V.ltv_pct("o", "c"), o=5000.0, c=None) is None


def test_utilization_null_on_zero_dp(spark):
    assert one(spark, V.utilization_pct("o", "d"), o=5000.0, d=0.0) is None
    assert one(spark, V.utilization_pct("o", "d"), o=5000.0, d=10000.0) == 50.0


def test_shortfall_and_margin_call(spark):
    assert one(spark, V.shortfall("o", "d"), o=12000.0, d=10000.0) == 2000.0
    assert one(spark, V.shortfall("o", "d"), o=8000.0, d=10000.0) == 0.0
    assert one(spark, V.is_margin_call("o", "d"), o=12000.0, d=10000.0) is True
    assert one(spark, V.is_margin_call("o", "d"), o=9000.0, d=10000.0) is False
    # strict: outstanding equal to drawing power is not a call
    assert one(spark, V.is_margin_call("o", "d"), o=10000.0, d=10000.0) is False


def test_npa_buckets_and_edges(spark):
    cases = {-3: "CURRENT", 0: "CURRENT", 1: "1-30", 15: "1-30", 30: "1-30", 31: "31-60", 45: "31-60",
             60: "31-60", 61: "61-90", 75: "61-90", 90: "61-90", 91: "90+", 120: "90+"}
    df = spark.createDataFrame([(k,) for k in cases], "dpd int")
    got = {r["dpd"]: r["b"] for r in df.select("dpd", V.npa_bucket("dpd").alias("b")).collect()}
    assert got == cases


def test_daily_interest(spark):
    v = one(spark, V.daily_interest("o", "r"), o=100000.0, r=12.045)
    assert round(v, 2) == 33.0


def test_margin_call_triggers_after_nav_drop(spark):
    df = spark.createDataFrame([(100.0, 200.0, 50.0, 9800.0)], "u double, n double, l double, o double")
    r = df.select(
        V.is_margin_call("o", V.drawing_power("u", "n", "l")).alias("before"),
        V.is_margin_call("o", V.drawing_power("u", F.col("n") * 0.88, "l")).alias("after"),
        V.shortfall("o", V.drawing_power("u", F.col("n") * 0.88, "l")).alias("short")).first()
    assert r["before"] is False and r["after"] is True
    assert round(r["short"], 6) == 1000.0


def test_segment_order_and_null_fallthrough(spark):
    rows = [(120, 0, 10.0), (0, 1, 10.0), (5, 0, 10.0), (0, 0, 50.0), (0, 0, None), (0, 0, 40.0)]
    df = spark.createDataFrame(rows, "d int, m int, w double")
    got = [r["s"] for r in df.select(V.segment("d", "m", "w").alias("s")).collect()]
    assert got == ["STRESSED", "STRESSED", "WATCH", "WATCH", "PRIME", "PRIME"]


def test_tokenize_matches_sha256(spark):
    import hashlib
    v = spark.createDataFrame([("abcde1234f",)], "pan string").select(V.tokenize("pan").alias("t")).first()["t"]
    assert v == hashlib.sha256(b"ABCDE1234F").hexdigest()


def test_change_hash_skips_nulls(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    h = [r["h"] for r in df.select(V.change_hash("x", "y", "z").alias("h")).collect()]
    assert h[0] == h[1]


def test_money_sum_is_order_independent(spark):
    vals = [0.1, 0.2, 0.3, 1e6 + 0.005, -0.3, 123.456789]
    a = spark.createDataFrame([(v,) for v in vals], "x double").agg(V.money_sum("x").alias("s")).first()["s"]
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "x double").repartition(3).agg(
        V.money_sum("x").alias("s")).first()["s"]
    assert a == b == 1000123.761789
