"""Repeated passages by sparse suffix arrays (operator 2).

A passage repeats when a window of ``min_words`` words stands in two or more
documents.  Suffixes are retained only at minimiser positions: of every
``window`` consecutive word k-grams the one with the smallest hash, so equal
text retains equal positions wherever it stands.  A repeated window then holds
a retained suffix among its first ``window`` words, and the suffixes of its
copies agree in their first min_words - window + 1 words (the core).

Retained suffixes are sorted by their core and each is compared with its
neighbours; those without an equal neighbour in another document go.  The rest
are extended to the left and right: each stands for the windows of min_words
words that begin up to ``window`` - 1 words before it, whose hashes are sorted
and compared with their neighbours in the same way.  The union of the windows
that agree is exactly the words covered by repeated passages, however long.

Sorting is by hash and streams through a group of any size; a group is never
gathered, and copies are never paired.

Cases: a null or empty text, or one of under min_words words, has no passage;
rows with the same id and text are one document; a null id is a document of
its own text; an empty table gives an empty result.  Words are compared as
they stand, white space is ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import cut, row_key, text_or_empty
from .tokens import Hasher, byte_texts, chunks, joined, mix, signed


def minimisers(grams, window: int):
    """Which of the k-gram hashes is the smallest of some ``window`` in a row (the last of equal ones)."""
    if len(grams) < window:
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams[::-1], window)
    at = np.arange(len(views)) + views.argmin(1)
    return np.unique(len(grams) - 1 - at)


def _retained(min_words: int, window: int, k: int):
    core = min_words - window + 1

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hasher = Hasher(lower=False)
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            rk = batch.column("rk").to_numpy()
            for lo, hi in chunks(texts):
                buf, begin = joined(texts[lo:hi])
                h, at, _ = hasher.tokens(buf)
                run = hasher.running(h)
                edge = np.append(np.searchsorted(at, begin), len(h))
                first = np.arange(max(len(h) - k + 1, 0))
                grams = mix(hasher.stretch(run, first, first + k), 1)
                cores, docs, places = [], [], []
                for i, (a, b) in enumerate(zip(edge[:-1], edge[1:]), lo):
                    if b - a < min_words:
                        continue
                    p = minimisers(grams[a : b - k + 1], window)
                    p = p[p <= b - a - core]
                    cores.append(mix(hasher.stretch(run, a + p, a + p + core), 2))
                    docs.append(np.full(len(p), rk[i]))
                    places.append(p.astype(np.int32))
                if cores:
                    yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(cores))), pa.array(np.concatenate(docs)),
                                                      pa.array(np.concatenate(places))], names=["key", "rk", "place"])
    return run


def _windows(min_words: int, window: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hasher = Hasher(lower=False)
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            rk, anchors = batch.column("rk").to_numpy(), batch.column("anchors")
            for lo, hi in chunks(texts):
                buf, begin = joined(texts[lo:hi])
                h, at, _ = hasher.tokens(buf)
                run = hasher.running(h)
                edge = np.append(np.searchsorted(at, begin), len(h))
                keys, docs, places = [], [], []
                for i, (a, b) in enumerate(zip(edge[:-1], edge[1:]), lo):
                    here = np.asarray(anchors[i].values.to_numpy())
                    p = np.unique((here[:, None] - np.arange(window)).ravel())
                    p = p[(p >= 0) & (p <= b - a - min_words)].astype(np.int64)
                    keys.append(mix(hasher.stretch(run, a + p, a + p + min_words), 4))
                    docs.append(np.full(len(p), rk[i]))
                    places.append(p.astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(keys))), pa.array(np.concatenate(docs)),
                                                  pa.array(np.concatenate(places))], names=["key", "rk", "place"])
    return run


def _repeated(sorted_by_key: DataFrame) -> DataFrame:
    """(rk, place, follows) of the rows whose key stands in another document too.  The rows are sorted by key and
    document, so the first and the last of a run differ if any two do; follows: an earlier document has the key."""
    run = W.partitionBy("key")
    return (sorted_by_key.select("rk", "place", F.min("rk").over(run).alias("r0"), F.max("rk").over(run).alias("r1"))
            .filter("r0 <> r1").select("rk", "place", F.expr("rk <> r0").alias("follows")))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50, window: int = 17,
                      k: int = 8) -> DataFrame:
    """A row for each repeated stretch of a document: doc_id, rk, first_word, end_word (words from 0, end exclusive)
    and follows_words: how many of its words have their first stand in another document (by row key)."""
    base = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("rk"), text_or_empty(text_col).alias("text"))
    kind = "key long, rk long, place int"
    anchors = _repeated(base.select("rk", "text").mapInArrow(_retained(min_words, window, k), kind))
    anchors = cut(anchors.groupBy("rk").agg(F.collect_set("place").alias("anchors")))
    texts = base.join(anchors, "rk").dropDuplicates(["rk"]).select("rk", "text", "anchors")
    found = cut(_repeated(texts.mapInArrow(_windows(min_words, window), kind)))
    # Windows that touch or overlap are one stretch.
    order = W.partitionBy("rk").orderBy("place")
    ends = F.col("place") + min_words
    begins = F.coalesce(F.col("place") > F.lag(ends).over(order), F.lit(True))
    found = found.withColumn("begins", begins).withColumn("covered", F.when(F.col("follows"), F.least(
        F.lit(min_words), ends - F.max(F.when(F.col("follows"), ends)).over(order.rowsBetween(W.unboundedPreceding, -1)))))
    found = found.withColumn("covered", F.when(F.col("follows") & F.col("covered").isNull(), min_words).otherwise(F.col("covered")))
    found = found.withColumn("stretch", F.sum(F.col("begins").cast("int")).over(order))
    spans = found.groupBy("rk", "stretch").agg(F.min("place").alias("first_word"), (F.max("place") + min_words).alias("end_word"),
                                               F.coalesce(F.sum("covered"), F.lit(0)).alias("follows_words"))
    ids = base.join(anchors.select("rk"), "rk", "left_semi").select("rk", "doc_id").distinct()
    return spans.join(ids, "rk").select("doc_id", "rk", "first_word", "end_word", "follows_words")


def passages_by_document(docs: DataFrame, **options) -> DataFrame:
    """One row for each document that has a repeated passage: doc_id, n_spans, n_words, follows_words, spans
    (first:end by place, comma-joined)."""
    spans = repeated_passages(docs, **options)
    at = F.sort_array(F.collect_list(F.struct("first_word", "end_word")))
    return (spans.groupBy("rk").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_spans"),
                                    F.sum(F.col("end_word") - F.col("first_word")).alias("n_words"),
                                    F.sum("follows_words").alias("follows_words"), at.alias("at"))
            .select("doc_id", "n_spans", "n_words", "follows_words",
                    F.array_join(F.transform("at", lambda s: F.concat_ws(":", s["first_word"], s["end_word"])), ",").alias("spans")))
