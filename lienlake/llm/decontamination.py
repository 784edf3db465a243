"""Benchmark decontamination by spaced-seed hashing (operator 7).

A document holds a benchmark item's passage if ``WINDOW`` consecutive words of
both agree in all but ``SUBSTITUTIONS`` places (items of fewer words, down to
``least_words``, must stand whole; shorter ones are no evidence).  Two fixed
masks of seven words each leave out word positions; of every window of 14 words
with up to 2 substitutions, one mask at some place touches no substituted word
(checked over all 91 cases in the tests), so no such overlap is missed.

All positions of the documents and of the items are hashed under the masks and
joined.  A hit gives a document, an item and their relative position; distinct
hits are verified on the words around them.  The items' side of the join is
broadcast only after a count shows that it is small (``broadcast_rows``); a
larger one is joined by a shuffle.

Cases: null and blank texts match nothing; equal words of any position count,
so ties do not matter; rows with the same id and text are judged alike; an item
is told by its id and its text, so a null id or one with several texts is no
exception; an empty table of documents or of items leaves everything clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, row_key, text_or_empty, words

# The masks' word positions, and the window and substitutions that they answer for.
MASKS = ((0, 1, 2, 3, 5, 6, 7), (0, 1, 2, 4, 7, 8, 9))
WINDOW, SUBSTITUTIONS = 14, 2


def _seeds(w: Column, mask: tuple[int, ...], number: int) -> Column:
    """Hashes of the masked words at every position of an array of words."""
    last = F.size(w) - mask[-1] - 1
    at = lambda i: F.xxhash64(F.lit(number), *[w[i + j] for j in mask])
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), at)).otherwise(F.array().cast("array<long>"))


def _placed(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, place, seed) for both masks; the seeds are hashed apart, so a place has two rows."""
    each = [F.transform(_seeds(F.col("w"), m, i), lambda s, j: F.struct(j.alias("place"), s.alias("seed"))) for i, m in enumerate(MASKS)]
    return rows.select(*keys, F.inline(F.concat(*each)))


def _lower_words(text_col: str) -> Column:
    return words(F.lower(text_or_empty(text_col)))


def _agreeing(w: Column, item: Column, shift: Column) -> Column:
    """For each word of the item, 1 if the document has it at its place plus ``shift``."""
    return F.transform(item, lambda x, j: F.coalesce(F.get(w, F.when(shift + j >= 0, shift + j)) == x, F.lit(False)).cast("int"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", least_words: int = 8, broadcast_rows: int = 1_000_000) -> DataFrame:
    """A row for each document and item whose passage it holds: doc_id, rk (row key), item_id, first_word (where the
    item begins in the document, maybe before its start) and agreeing (the item's words that stand there)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("rk"), _lower_words(text_col).alias("w"))
    asked = items.select(F.col(item_col).alias("item_id"), row_key(item_col, item_text_col).alias("item"), _lower_words(item_text_col).alias("w"))
    asked = cut(asked.filter(F.size("w") >= least_words).dropDuplicates(["item"]))
    seeds = _placed(asked, "item").withColumnRenamed("place", "item_place")
    n = asked.agg(F.coalesce(F.sum(len(MASKS) * F.size("w")), F.lit(0))).first()[0]
    seeds = F.broadcast(seeds) if n <= broadcast_rows else seeds
    hits = _placed(rows.select("rk", "w"), "rk").join(seeds, "seed")
    hits = hits.select("rk", "item", (F.col("place") - F.col("item_place")).alias("shift")).distinct()
    hits = cut(hits.groupBy("rk").agg(F.collect_list(F.struct("item", "shift")).alias("hits")))
    return _verified(rows.join(hits, "rk").select("doc_id", "rk", "w", "hits"), asked, n <= broadcast_rows)


def _verified(found: DataFrame, asked: DataFrame, small: bool) -> DataFrame:
    """The hits whose stretch of the document, as long as the longest item, holds the item's passage."""
    longest = asked.agg(F.coalesce(F.max(F.size("w")), F.lit(0))).scalar()
    local = F.transform("hits", lambda h: F.struct(
        h["item"].alias("item"), h["shift"].alias("shift"),
        F.slice("w", F.greatest(h["shift"], F.lit(0)) + 1, F.col("longest")).alias("near"), F.least(h["shift"], F.lit(0)).alias("from")))
    each = found.withColumn("longest", longest).select("doc_id", "rk", F.inline(local))
    passage = asked.select("item", "item_id", F.col("w").alias("passage"))
    each = each.join(F.broadcast(passage) if small else passage, "item")
    n = F.size("passage")
    each = each.withColumn("same", _agreeing(F.col("near"), F.col("passage"), F.col("from")))
    add = lambda s: F.aggregate(s, F.lit(0), lambda a, x: a + x)
    total = add(F.col("same"))
    window = F.exists(F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))),
                      lambda i: add(F.slice("same", i + 1, WINDOW)) >= WINDOW - SUBSTITUTIONS)
    each = each.withColumn("agreeing", total).filter(F.when(n >= WINDOW, window).otherwise(total == n))
    best = F.max(F.struct("agreeing", -F.col("shift")))
    return (each.groupBy("doc_id", "rk", "item", "item_id").agg(best.alias("b"))
            .select("doc_id", "rk", "item_id", (-F.col("b")["col2"]).cast("int").alias("first_word"), F.col("b.agreeing").alias("agreeing")))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage."""
    gone = contaminated(docs, items, id_col, text_col, **options).select(F.col("rk").alias("__gone")).distinct()
    return docs.join(gone, row_key(id_col, text_col) == F.col("__gone"), "left_anti")
