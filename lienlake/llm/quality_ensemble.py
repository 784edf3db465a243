"""Quality by a sparse rule ensemble (operator 4).

Shallow trees are grown on statistics of the texts; each path from a root to a
node is a conjunction of thresholds, a rule.  A logistic regression with a lasso
penalty on the rules keeps a few of them (Friedman and Popescu, "Predictive
Learning via Rule Ensembles", 2008), and those are compiled into one Spark
column expression over the statistics, which scores all texts.

The statistics are gathered in one pass over all whole texts.  The ensemble is
fitted on a bounded sample of about ``rows`` labelled texts, with Spark's own
random forest and logistic regression.  Labels come only from ids that are not
held out; only the text is an input of a score.

Cases: a null text scores as an empty one (all statistics 0); with labels of one
kind only, or none, every text scores that kind's share (0 without labels); an
empty table gives an empty result; rows are scored one by one, so repeated ids
do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_bucket, cut, labelled_sample, row_key, text_or_empty
from .tokens import Hasher, byte_texts, chunks, joined

STATISTICS = ("log_words", "word_length", "upper", "digits", "symbols", "marks", "not_ascii", "different_words", "same_as_before",
              "most_frequent", "words_a_line", "repeated_lines", "ends_in_letter")


def _byte_classes():
    """Class of each byte: 0 other, 1 upper, 2 lower, 3 digit, 4 symbol, 5 mark, 6 lead of a longer character, 7 its rest."""
    kind = np.zeros(256, np.int64)
    kind[65:91], kind[97:123], kind[48:58] = 1, 2, 3
    kind[[ord(c) for c in "#*$%&|<>@^~_=+\\{}[]"]] = 4
    kind[[ord(c) for c in ".,;:!?\"'()-/"]] = 5
    kind[192:], kind[128:192] = 6, 7
    return kind


def _statistics(batches: Iterator) -> Iterator:
    import pyarrow as pa

    hasher, classes = Hasher(lower=False), _byte_classes()
    for batch in batches:
        texts = byte_texts(batch.column("text"))
        out = np.zeros((len(STATISTICS), len(texts)))
        for lo, hi in chunks(texts):
            buf, begin = joined(texts[lo:hi])
            a, n = np.frombuffer(buf, np.uint8), hi - lo
            length = np.diff(np.append(begin, len(a)))
            doc = np.repeat(np.arange(n), length)
            kinds = np.bincount(doc * 8 + classes[a], minlength=8 * n).reshape(n, 8)
            h, at, end = hasher.tokens(buf)
            of = np.searchsorted(begin, at, "right") - 1
            words = np.bincount(of, minlength=n)
            per = np.maximum(words, 1)
            chars = np.maximum(kinds.sum(1) - kinds[:, 7] - 1, 1)
            same = np.flatnonzero((h[1:] == h[:-1]) & (of[1:] == of[:-1]))
            letter = np.isin(classes[a[end - 1]], (1, 2, 6, 7))
            edge = np.append(np.searchsorted(of, np.arange(n)), len(h))
            different, most, lines, repeated = np.zeros(n), np.zeros(n), np.ones(n), np.zeros(n)
            for i in range(n):
                if words[i]:
                    counts = np.unique(h[edge[i] : edge[i + 1]], return_counts=True)[1]
                    different[i], most[i] = len(counts), counts.max()
                    own = [x for x in texts[lo + i].split(b"\n") if x.strip()]
                    lines[i], repeated[i] = max(len(own), 1), len(own) - len(set(own))
            out[:, lo:hi] = (np.log1p(words), np.bincount(of, end - at, n) / per,
                             kinds[:, 1] / chars, kinds[:, 3] / chars, kinds[:, 4] / chars, kinds[:, 5] / chars, kinds[:, 6] / chars,
                             different / per, np.bincount(of[same], minlength=n) / per, most / per, words / lines, repeated / lines,
                             np.bincount(of, letter, n) / per)
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(x) for x in out], names=kept + list(STATISTICS))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, rk (row key) and the statistics of each row's text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("rk"), text_or_empty(text_col).alias("text"))
    kind = dict(docs.dtypes)[id_col]
    return rows.mapInArrow(_statistics, f"doc_id {kind}, rk long, " + ", ".join(f"{c} double" for c in STATISTICS))


@dataclass(frozen=True)
class Rule:
    """A conjunction: (statistic, at most, threshold) each, with its weight."""
    terms: tuple[tuple[str, bool, float], ...]
    weight: float

    def column(self) -> Column:
        out = F.lit(True)
        for name, at_most, threshold in self.terms:
            out = out & ((F.col(name) <= threshold) if at_most else (F.col(name) > threshold))
        return out


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[Rule, ...]
    intercept: float

    def score(self) -> Column:
        """The ensemble as a Spark column over the statistics."""
        margin = F.lit(self.intercept)
        for rule in self.rules:
            margin = margin + F.when(rule.column(), rule.weight).otherwise(0.0)
        return 1 / (1 + F.exp(-margin))


def tree_paths(model) -> list[tuple[tuple[str, bool, float], ...]]:
    """The paths from the root to every other node of a forest's trees, each as its simplest conjunction."""
    found = {}

    def walk(node, terms):
        if terms:
            least = {}
            for name, at_most, threshold in terms:
                old = least.get((name, at_most))
                least[name, at_most] = threshold if old is None else (min if at_most else max)(old, threshold)
            found[tuple(sorted((n, side, t) for (n, side), t in least.items()))] = None
        if node.subtreeDepth() > 0:
            split = node.split()
            name, threshold = STATISTICS[split.featureIndex()], float(split.threshold())
            walk(node.leftChild(), [*terms, (name, True, threshold)])
            walk(node.rightChild(), [*terms, (name, False, threshold)])
    for tree in model.trees:
        walk(tree._call_java("rootNode"), [])
    return list(found)


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", modulus: int = 5, held_out: int = 0,
        rows: int = 20_000, trees: int = 12, depth: int = 3, lasso: float = 0.003) -> Ensemble:
    """The ensemble, fitted on about ``rows`` labelled texts that are not held out."""
    sample = F.broadcast(labelled_sample(labels, label_col, id_col, modulus, held_out, rows))  # about ``rows`` rows at most
    known = cut(stats.join(sample, stats["doc_id"] == sample["id"]).select("label", *STATISTICS).coalesce(2))
    kinds = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not kinds.get(0) or not kinds.get(1):
        return Ensemble((), 30.0 if kinds.get(1) else -30.0)
    as_vector = known.select("label", array_to_vector(F.array(*STATISTICS)).alias("x"))
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, maxBins=64, seed=3,
                                    featureSubsetStrategy="0.5", minInstancesPerNode=5).fit(as_vector)
    paths = tree_paths(forest)
    holds = [Rule(p, 0.0).column().cast("double") for p in paths]
    if not holds:
        return Ensemble((), float(np.log(kinds[1] / kinds[0])))
    lasso_fit = LogisticRegression(featuresCol="r", labelCol="label", elasticNetParam=1.0, regParam=lasso, maxIter=100, standardization=False)
    model = lasso_fit.fit(known.select("label", array_to_vector(F.array(*holds)).alias("r")))
    kept = [Rule(p, float(w)) for p, w in zip(paths, model.coefficients.toArray()) if w]
    return Ensemble(tuple(kept), float(model.intercept))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 5, held_out: int = 0,
          threshold: float = 0.3, **options) -> DataFrame:
    """One row per row: doc_id, rk (row key), held_out, score, predicted."""
    stats = cut(statistics(docs, id_col, text_col))
    ensemble = fit(stats, labels, id_col, modulus=modulus, held_out=held_out, **options)
    return stats.select("doc_id", "rk", F.coalesce(crc_bucket("doc_id", modulus) == held_out, F.lit(False)).alias("held_out"),
                        ensemble.score().alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
