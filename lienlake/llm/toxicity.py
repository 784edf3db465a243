"""Toxicity by a character n-gram linear classifier with naive Bayes log-count ratios (operator 1).

Features are the presence of character n-grams, ``SHORTEST`` to ``LONGEST``
characters of the lower-cased text, hashed into 2^BITS buckets.  Each is scaled
by its log-count ratio r = log(share of toxic texts with it / share of others),
smoothed, and a logistic regression is fitted on the scaled features (Wang and
Manning, "Baselines and Bigrams", 2012).

The classifier is fitted on a bounded sample of about ``rows`` labelled texts.
Buckets are counted by label in the tasks and summed by Spark; the
``features`` that tell the labels apart best go to the driver, and of each
sampled text the buckets among them.  Scoring then is one pass over all whole
texts with the weights' table.  Labels come only from ids that are not held
out; only the text is an input of a score.

Cases: a null text scores as an empty one (the intercept); with labels of one
kind only, or none, every text scores that kind's share (0 without labels); an
empty table gives an empty result; rows are scored one by one, so repeated ids
do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_bucket, cut, labelled_sample, row_key, text_or_empty
from .tokens import mix

SHORTEST, LONGEST, BITS = 3, 6, 21


class Grams:
    """Buckets of the character n-grams of a list of texts."""

    def __init__(self, shortest: int = SHORTEST, longest: int = LONGEST, bits: int = BITS):
        self.shortest, self.longest, self.bits = shortest, longest, bits

    def __call__(self, texts: list):
        """(bucket, text number) of every n-gram, order by order."""
        gap = "\0" * self.longest  # no n-gram spans two texts: those with a gap's character are left out
        spaced = [" " + t.replace("\0", " ").lower() + " " for t in texts]
        chars = np.frombuffer(gap.join(spaced).encode("utf-32-le", "surrogatepass"), np.uint32)
        begin = np.concatenate(([0], np.cumsum([len(t) + len(gap) for t in spaced[:-1]]))).astype(np.int64)
        number = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(np.append(begin, len(chars))))
        code = mix(chars.astype(np.uint64))
        gaps = np.concatenate(([0], np.cumsum(chars == 0)))
        base = np.uint64(0xC2B2AE3D27D4EB4F)
        h, power = code.copy(), np.uint64(1)
        with np.errstate(over="ignore"):
            for n in range(2, self.longest + 1):
                power = power * base
                h = h[:-1] + code[n - 1 :] * power
                if n >= self.shortest:
                    whole = np.flatnonzero(gaps[n:] == gaps[: max(len(gaps) - n, 0)])
                    g = h[whole]
                    g = (g ^ (g >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15 + 2 * n)
                    yield (g >> np.uint64(64 - self.bits)).astype(np.int64), number[whole]


def _parts(column):
    """The texts of an Arrow column by runs of about a quarter of a million bytes, so that a batch is never whole in Python:
    (first row, row after the last, texts)."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    lo = 0
    while lo < len(sizes):
        hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo : lo + (1 << 14)] + 1), 1 << 18, "right")))
        yield lo, hi, [t or "" for t in column.slice(lo, hi - lo).to_pylist()]
        lo = hi


def _counts(batches: Iterator) -> Iterator:
    """(bucket, toxic, other): in how many texts of the task each bucket occurs."""
    import pyarrow as pa

    grams, table = Grams(), np.zeros((2, 1 << BITS), np.int32)
    for batch in batches:
        labels = batch.column("label").to_numpy()
        for lo, hi, texts in _parts(batch.column("text")):
            for bucket, number in grams(texts):
                seen = np.unique((number.astype(np.int64) << BITS) | bucket)
                kind = labels[lo:hi][seen >> BITS]
                for k in (0, 1):
                    np.add.at(table[k], seen[kind == k] & ((1 << BITS) - 1), np.int32(1))
    found = np.flatnonzero(table.any(0))
    for at in range(0, len(found), 50_000):
        b = found[at : at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(b.astype(np.int32)), pa.array(table[1, b]), pa.array(table[0, b])],
                                         names=["bucket", "toxic", "other"])


def _present(slot):
    """Of each text the numbers of the selected features that it has; ``slot``: broadcast table bucket -> number or -1."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        grams, table = Grams(), slot.value
        for batch in batches:
            for lo, hi, texts in _parts(batch.column("text")):
                pairs = [((number[k := np.flatnonzero(table[bucket] >= 0)]).astype(np.int64) << 32) | table[bucket[k]]
                         for bucket, number in grams(texts)]
                pairs = np.unique(np.concatenate(pairs))
                ends = np.searchsorted(pairs >> 32, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(lo, hi - lo),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)))],
                    names=["label", "present"])
    return run


def _score(table, intercept: float, column):
    """Score of each text of an Arrow column; ``table``: the buckets' weights, 0 where not selected."""
    grams, out = Grams(), np.zeros(len(column))
    for lo, hi, texts in _parts(column):
        pairs = []
        for bucket, number in grams(texts):
            k = np.flatnonzero(table[bucket])
            pairs.append((number[k].astype(np.int64) << BITS) | bucket[k])
        pairs = np.unique(np.concatenate(pairs))
        out[lo:hi] = np.bincount(pairs >> BITS, table[pairs & ((1 << BITS) - 1)], hi - lo)
    return 1 / (1 + np.exp(-np.clip(out + intercept, -30, 30)))


def _scores(weights, intercept: float):
    """The rows with the score of their text in its place; ``weights``: broadcast table of the buckets' weights."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            score, others = _score(weights.value, intercept, batch.column("text")), [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in others] + [pa.array(score)], names=[*others, "score"])
    return run


def _score_of(weights, intercept: float):
    """The score as a function of a text column, which leaves the other columns in Spark."""
    import pyarrow as pa

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(_score(weights.value, intercept, texts))
    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}  # the module's annotations are strings
    return F.arrow_udf(run, "double")


@dataclass
class Model:
    """Weights of the selected buckets and the intercept."""
    buckets: np.ndarray
    weights: np.ndarray
    intercept: float

    def table(self):
        out = np.zeros(1 << BITS, np.float32)
        out[self.buckets] = self.weights
        return out


def logistic(texts, features, ratio, labels, l2: float = 1.0, rounds: int = 15):
    """Weights and intercept of a logistic regression on present features scaled by ``ratio``; ``texts`` and
    ``features`` are the places of the ones.  Newton's method, its steps found by conjugate gradients; products run over
    a million places at a time, so that they need little memory besides the places themselves."""
    n, m = len(labels), len(ratio)
    blocks = [slice(lo, lo + (1 << 20)) for lo in range(0, len(features), 1 << 20)]

    def forward(v):
        scaled = ratio * v[:m]
        return sum((np.bincount(texts[b], scaled[features[b]], n) for b in blocks), np.zeros(n)) + v[m]

    def back(e):
        return np.append(ratio * sum((np.bincount(features[b], e[texts[b]], m) for b in blocks), np.zeros(m)), e.sum())
    penalty = np.append(np.full(m, l2), 1e-6)
    v = np.zeros(m + 1)

    def loss(v):
        z = forward(v)
        return (np.logaddexp(0, z) - labels * z).sum() + 0.5 * (penalty * v * v).sum()
    now = loss(v)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(forward(v), -30, 30)))
        gradient = back(p - labels) + penalty * v
        curve = p * (1 - p)
        step, rest = np.zeros(m + 1), -gradient
        way, size = rest.copy(), rest @ rest
        goal = 1e-2 * size
        for _ in range(30):
            if size <= goal:
                break
            bent = back(curve * forward(way)) + penalty * way
            far = size / (way @ bent)
            step, rest = step + far * way, rest - far * bent
            size, last = rest @ rest, size
            way = rest + size / last * way
        far, then = 1.0, loss(v + step)
        while then > now and far > 1e-4:
            far /= 2
            then = loss(v + far * step)
        v, before, now = v + far * step, now, then
        if before - now < 1e-4 * abs(before):
            break
    return v[:m], v[m]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        modulus: int = 4, held_out: int = 2, rows: int = 20_000, features: int = 20_000) -> Model:
    """The classifier, fitted on about ``rows`` labelled texts that are not held out."""
    spark = docs.sparkSession
    sample = F.broadcast(labelled_sample(labels, label_col, id_col, modulus, held_out, rows))  # about ``rows`` rows at most
    texts = cut(docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).join(sample, "id").select("text", "label"))
    kinds = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}
    p, q = kinds.get(1, 0), kinds.get(0, 0)
    if not p or not q:
        return Model(np.zeros(0, np.int64), np.zeros(0), 30.0 if p else -30.0)
    counted = texts.mapInArrow(_counts, "bucket int, toxic int, other int").groupBy("bucket").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).filter("toxic + other >= 4")
    ratio = F.log((F.col("toxic") + 1) / (p + 2.0)) - F.log((F.col("other") + 1) / (q + 2.0))
    sure = F.abs(ratio) / F.sqrt(1 / (F.col("toxic") + 1.0) + 1 / (F.col("other") + 1.0))
    best = (counted.select("bucket", ratio.alias("ratio"), sure.alias("sure")).filter("sure >= 3")
            .orderBy(F.desc("sure"), "bucket").limit(features).collect())
    buckets, ratio = np.array([r["bucket"] for r in best], np.int64), np.array([r["ratio"] for r in best])
    slot = np.full(1 << BITS, -1, np.int32)
    slot[buckets] = np.arange(len(buckets))
    held = spark.sparkContext.broadcast(slot)
    got = texts.mapInArrow(_present(held), "label int, present array<int>").toArrow()
    held.unpersist()
    present = got.column("present").combine_chunks()
    counts = present.value_lengths().to_numpy()
    w, b = logistic(np.repeat(np.arange(len(counts), dtype=np.int32), counts), present.flatten().to_numpy(), ratio, got.column("label").to_numpy().astype(float))
    return Model(buckets, w * ratio, float(b))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", modulus: int = 4, held_out: int = 2,
          threshold: float = 0.3) -> DataFrame:
    """One row per row: doc_id, rk (row key), held_out, score, predicted."""
    table = docs.sparkSession.sparkContext.broadcast(model.table())
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("rk"), text_or_empty(text_col).alias("text"))
    kind = dict(docs.dtypes)[id_col]
    scored = rows.mapInArrow(_scores(table, model.intercept), f"doc_id {kind}, rk long, score double")
    return scored.select("doc_id", "rk", F.coalesce(crc_bucket("doc_id", modulus) == held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows whose text is predicted to be toxic.  A score is of the text alone, so each row is judged
    where it is read: no text is shuffled."""
    model = fit(docs, labels, id_col, text_col)
    score_of = _score_of(docs.sparkSession.sparkContext.broadcast(model.table()), model.intercept)
    return docs.filter(score_of(text_or_empty(text_col)) < threshold)
