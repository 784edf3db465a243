"""Classifiers: accuracy on what was held out, defined results in odd cases."""

import binascii

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lienlake.llm import quality_ensemble, queries, toxicity
from lienlake.llm.common import row_key

SF = "/root/testdata/sf0.01"


def crc(doc_id, modulus):
    return binascii.crc32(str(doc_id).encode()) % modulus


@pytest.fixture(scope="module")
def truth(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def rates(rows, truth, label):
    held = [(truth[r["doc_id"]][label], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    return held.count((1, 1)), held.count((0, 1)), held.count((1, 0)), held.count((0, 0))


def test_toxicity_of_held_out_texts(spark, truth):
    rows = queries.op1_toxicity(spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (crc(r["doc_id"], 4) == 2) for r in rows)
    tp, fp, fn, tn = rates(rows, truth, "toxic")
    assert fp <= 0.05 * (fp + tn) and tp >= 0.6 * (tp + fn)


def test_toxic_rows_go_where_they_are_read(spark, edges, labels):
    """The verdict is of the text alone: rows are judged in one pass, without a shuffle of texts."""
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs = documents.select((F.col("doc_id") + 100).alias("doc_id"), "text", "lang", "source", "n_chars", F.lit("x").alias("score"), F.lit(1).alias("rk"),
                            F.lit("y").alias("size")).union(edges)
    known = spark.read.parquet(f"{SF}/labels.parquet").withColumn("doc_id", F.col("doc_id") + 100)
    kept = toxicity.drop_toxic(docs, known)
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    scored = toxicity.score(docs, toxicity.fit(docs, known)).select("rk", "predicted").distinct().collect()
    verdict = dict(map(tuple, scored))
    assert len(verdict) == len(scored) and set(verdict.values()) == {0, 1}
    keyed = docs.withColumn("key", row_key()).collect()
    assert sorted(map(str, kept.collect())) == sorted(str(Row(**{c: r[c] for c in docs.columns})) for r in keyed if not verdict[r["key"]])


def test_parts_hold_each_text_once():
    texts = [None, "", "a" * 400_000, "é" * 200_000, None, *["b" * 9] * 40_000, "c" * 300_000]
    parts = list(toxicity._parts(pa.array(texts)))
    assert [t for *_, run in parts for t in run] == [t or "" for t in texts]
    assert [lo for lo, _, _ in parts] == [0, *(hi for _, hi, _ in parts[:-1])] and parts[-1][1] == len(texts)
    assert all(hi - lo == len(run) and (hi - lo == 1 or sum(len(t.encode()) + 1 for t in run) <= 1 << 18) for lo, hi, run in parts)
    assert not list(toxicity._parts(pa.array([], pa.string())))


def test_quality_of_held_out_texts(spark, truth):
    rows = queries.op4_quality_ensemble(spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (crc(r["doc_id"], 5) == 0) for r in rows)
    tp, fp, fn, tn = rates(rows, truth, "quality")
    assert (tp + tn) >= 0.95 * (tp + fp + fn + tn)


@pytest.mark.parametrize("kind", [None, 0, 1])
def test_labels_of_one_kind(spark, edges, nothing, kind):
    rows = [] if kind is None else [(i, kind, kind) for i in range(1, 11)] + [(None, 1 - kind, 1 - kind), (1, None, None)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int, quality int")
    want = {None: 0, 0: 0, 1: 1}[kind]
    scored = toxicity.score(edges, toxicity.fit(edges, labels)).collect()
    assert len(scored) == edges.count() and all(round(r["score"]) == want for r in scored)
    scored = quality_ensemble.score(edges, labels).collect()
    assert len(scored) == edges.count() and all(round(r["score"]) == want for r in scored)
    assert toxicity.score(nothing, toxicity.fit(nothing, labels)).count() == 0
    assert quality_ensemble.score(nothing, labels).count() == 0


def test_logistic_regression_finds_the_minimum():
    rng = np.random.default_rng(0)
    x = rng.random((200, 6)) < 0.4
    ratio = np.array([2.0, -1.0, 0.5, 1.0, -2.0, 0.1])
    y = (rng.random(200) < 1 / (1 + np.exp(-(x @ np.array([2.0, -1, 0, 1, -2, 0]) - 0.5)))).astype(float)
    texts, features = np.nonzero(x)
    w, b = toxicity.logistic(texts, features, ratio, y)
    p = 1 / (1 + np.exp(-((x * ratio) @ w + b)))
    assert np.abs((x * ratio).T @ (p - y) + w).max() < 0.05 and abs((p - y).sum()) < 0.05


def test_grams_stay_within_their_texts():
    grams = toxicity.Grams()
    alone = [{(int(b)) for bucket, _ in grams([t]) for b in bucket} for t in ("Idiot é", "", "ab", "x\0y")]
    together = [set() for _ in alone]
    for bucket, number in grams(["Idiot é", "", "ab", "x\0y"]):
        for b, i in zip(bucket.tolist(), number.tolist()):
            together[i].add(b)
    assert together == alone and len(alone[0]) == sum(max(9 - n + 1, 0) for n in range(3, 7)) and not alone[1]


def test_rules_are_paths(spark):
    rule = quality_ensemble.Rule((("symbols", True, 0.5), ("upper", False, 0.1)), 1.0)
    df = spark.createDataFrame([(0.5, 0.2), (0.6, 0.2), (0.5, 0.1)], "symbols double, upper double")
    assert [r[0] for r in df.select(rule.column()).collect()] == [True, False, False]
