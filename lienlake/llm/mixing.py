"""Mixing sources to target weights by weighted fair queueing (operator 9).

Each source is a queue of its documents in a random but fixed order (by a hash
of their id), repeated up to ``repeats`` times.  A document's virtual finish
time is the words that its source has sent up to and with it, divided by the
source's target; the mix is all documents in the order of that time, cut off
when the budget - the words of the whole corpus - is used up.

Nothing is sent twice as late as its target asks (a finish time over 2), which
bears only on sources whose documents are larger than their targets.

Running sums are never taken over a whole source or over the whole corpus in
one task: documents fall into buckets of a few thousand rows along the
order, buckets are summed first, and only the order within a bucket is sorted.

Cases: a null text has 0 words and is never taken; a null source is a source of
its own, the last; sources of 0 words get nothing; rows with the same id and
text share a place in the order and count separately; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import SPACE, cut, row_key, text_or_empty

#: Documents (or finish times) that a bucket holds on average.
BUCKET = 5_000


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SPACE.replace("[", "[^", 1))).cast("long")


def targets(sizes: DataFrame, repeats: int = 3, cycle: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size): sources in order weigh 1 to ``cycle``, repeating;
    no target exceeds ``repeats`` times its source, and what is over is shared by weight among the others.

    A source is held at its bound if it would exceed it even after all sources with a lower bound per weight have
    been held at theirs; so one pass in that order finds the level.  The table has one row per source."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("weight", (F.row_number().over(by_name) - 1) % cycle + 1)
    s = s.withColumn("bound", F.lit(repeats) * F.col("source_size"))
    order = W.orderBy((F.col("bound") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(1))
    s = (s.withColumn("left_words", F.sum("source_size").over(everything) - F.coalesce(F.sum("bound").over(before), F.lit(0)))
         .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    s = s.withColumn("held", F.col("bound") * F.col("left_weight") < F.col("left_words") * F.col("weight"))
    free = F.when(~F.col("held"), F.struct("left_weight", "left_words"))
    s = s.withColumn("level", F.max(free).over(everything))
    share = F.col("level.left_words").cast("double") * F.col("weight") / F.col("level.left_weight")
    return s.select("source", "source_size", F.when(F.col("held"), F.col("bound").cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        repeats: int = 3, seed: int = 17) -> DataFrame:
    """One row per row of ``docs``: doc_id, rk (row key), source, size, source_size, target, finish (first virtual
    finish time), copies (times that the mix takes it), taken (words)."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), row_key(id_col, text_col).alias("rk"),
                       n_words(text_or_empty(text_col)).alias("size"))
    base = cut(base.withColumn("place", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}"))
                                              .cast("binary"))))
    per = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    per = cut(targets(per.select("source", "source_size"), repeats).join(per.select(F.col("source").alias("s2"), "n"),
                                                                       F.expr("source <=> s2")).drop("s2"))
    # Buckets along each source's order: the first digits of the hash, which are uniform.
    slot = F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * F.ceil(F.col("n") / BUCKET) / F.lit(2**32)).cast("int")
    rows = base.join(per.withColumnRenamed("source", "s2"), F.expr("source <=> s2")).drop("s2").withColumn("slot", slot)
    sums = rows.groupBy("source", "slot").agg(F.sum("size").alias("sent"))
    sums = sums.select(F.col("source").alias("s2"), F.col("slot").alias("slot2"),
                       (F.sum("sent").over(W.partitionBy("source").orderBy("slot")) - F.col("sent")).alias("ahead"))
    rows = rows.join(sums, F.expr("source <=> s2 and slot = slot2"))
    inside = W.partitionBy("source", "slot").orderBy("place", "doc_id", "rk").rowsBetween(W.unboundedPreceding, 0)
    rows = cut(rows.select("doc_id", "rk", "source", "size", "source_size", "target", "place",
                           (F.col("ahead") + F.sum("size").over(inside)).alias("sent")))
    # One entry for each time that a document may be sent, with its virtual finish time.
    turn = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    sends = rows.filter("size > 0 and target > 0").withColumn("turn", turn)
    sends = sends.withColumn("finish", (F.col("turn") * F.col("source_size") + F.col("sent")).cast("double") / F.col("target"))
    sends = sends.filter("finish <= 2.0").select("rk", "doc_id", "source", "place", "turn", "finish", "size")
    n = rows.count()
    step = max(1, round(n / BUCKET))
    sends = sends.withColumn("slice", F.floor(F.col("finish") * step).cast("int"))
    budget = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("budget"))
    ahead = sends.groupBy("slice").agg(F.sum("size").alias("sent"))
    ahead = ahead.select("slice", "sent", (F.sum("sent").over(W.orderBy("slice")) - F.col("sent")).alias("ahead"))
    last = W.partitionBy("slice").orderBy("finish", F.col("source").asc_nulls_last(), "place", "doc_id", "rk", "turn")
    upto = F.col("ahead") + F.sum("size").over(last.rowsBetween(W.unboundedPreceding, 0))
    taken = (sends.join(ahead.select("slice", "ahead"), "slice").withColumn("upto", upto)
             .filter(F.col("upto") <= budget.scalar()))
    copies = taken.groupBy("rk").agg(F.count("*").alias("sent_rows"))
    same = rows.groupBy("rk").agg(F.count("*").alias("rows"))
    # Rows with the same id and text share what was taken of them, as evenly as whole copies allow.
    share = copies.join(same, "rk")
    number = F.row_number().over(W.partitionBy("rk").orderBy("sent"))
    out = rows.join(share, "rk", "left").withColumn("number", F.when(F.col("rows") > 1, number).otherwise(F.lit(1)))
    count = F.coalesce(F.floor(F.col("sent_rows") / F.col("rows")) + F.when(F.col("number") <= F.col("sent_rows") % F.col("rows"), 1).otherwise(0), F.lit(0))
    return out.select("doc_id", "rk", "source", "size", "source_size", "target",
                      F.when(F.col("target") > 0, F.col("sent").cast("double") / F.col("target")).alias("finish"),
                      count.cast("int").alias("copies"), (count * F.col("size")).cast("long").alias("taken"))
