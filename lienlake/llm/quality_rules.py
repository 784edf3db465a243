"""Quality rules as a short-circuit cascade (operator 6).

A rule is a Spark condition that holds for a text to be rejected.  Rules run in
the order of rejections per second of cost, both estimated on a sample of
``sample_rows`` rows: each rule is run alone over the sample, timed against a
run that only reads it, and counted on what the rules before it let through.
The cascade is one CASE expression, whose later conditions are computed only
for texts that passed the earlier ones.  The order bears on the time only: a
text is kept if no rule holds, whatever the order.

Cases: a null text has no words, as an empty one, and is rejected by the base
rule; an empty table gives an empty result (and keeps the rules as listed);
rows are judged one by one, so repeated ids and ties do not matter.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, let, text_or_empty, words

#: Characters counted as symbols.
SYMBOLS = r"[#*$%&|<>]"


def windows(w: Column, k: int = 5) -> Column:
    """Hashes of the k-word windows of an array of words, each word hashed once."""
    def of(h: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
        return F.when(F.size(h) >= k, each).otherwise(F.array().cast("array<long>"))
    return let(F.transform(w, lambda x: F.xxhash64(x)), of)


def _before(a: Column) -> Column:
    return F.concat(F.transform(F.slice(a, 1, 1), lambda x: F.nullif(x, x)), F.slice(a, 1, F.size(a) - 1))


def _after(a: Column) -> Column:
    return F.concat(F.slice(a, 2, F.size(a)), F.transform(F.slice(a, 1, 1), lambda x: F.nullif(x, x)))


def repeated_words(g: Column, k: int = 5) -> Column:
    """How many words stand in k-word windows that the text has twice or more (all of them, the first included), from
    the windows' hashes.

    Windows are sorted with their places; those equal to a neighbour are repeated; their places, sorted again, tell
    how far each window reaches beyond the one before."""
    def covered(g: Column) -> Column:
        placed = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        def reach(places: Column) -> Column:
            steps = F.zip_with(places, _before(places), lambda p, q: F.coalesce(F.least(p - q, F.lit(k)), F.lit(k)))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)
        def repeated(s: Column) -> Column:
            h = F.transform(s, lambda x: x["h"])
            twin = let(h, lambda v: F.zip_with(F.zip_with(v, _before(v), lambda a, b: F.coalesce(a == b, F.lit(False))),
                                               F.zip_with(v, _after(v), lambda a, b: F.coalesce(a == b, F.lit(False))), lambda a, b: a | b))
            places = F.transform(F.filter(F.arrays_zip(s.alias("s"), twin.alias("t")), lambda x: x["t"]), lambda x: x["s"]["i"])
            return let(F.sort_array(places), reach)
        return let(placed, repeated)
    return F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)).otherwise(F.lit(0).cast("long"))


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with columns __text, __words, __letters (how many) and the base statistics n_words, word_chars, n_symbols, n_lines,
    n_dup_lines, n_repeat_words (long)."""
    w, lines = F.col("__words"), F.col("__lines")
    out = docs.withColumn("__text", text_or_empty(text_col))
    out = out.withColumn("__words", words(F.col("__text"))).withColumn(
        "__lines", F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    return out.withColumns({
        "n_words": F.size(w).cast("long"), "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.regexp_count("__text", F.lit(SYMBOLS)).cast("long"), "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"), "__letters": F.regexp_count("__text", F.lit(r"\p{L}")), "__windows": windows(w)}).withColumn(
        "n_repeat_words", repeated_words(F.col("__windows"))).drop("__lines", "__windows")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """The method's rules: what each rejects, from the statistics and the text."""
    n = F.col("n_words")
    letters = F.col("__letters")
    return {
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n),
        "symbols": 10 * F.col("n_symbols") > n,
        "repeated_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "few_letters": 2 * letters < F.col("word_chars"),
        "capitals": 2 * F.regexp_count("__text", F.lit(r"\p{Lu}")) > letters,
        "few_different_words": (n >= 100) & (20 * F.size(F.array_distinct("__words")) < n),
        "cut_lines": 10 * F.regexp_count("__text", F.lit(r"(?m)(?:\.\.\.|…)$")) > 3 * F.greatest(F.col("n_lines"), F.lit(1)),
    }


def order_rules(docs: DataFrame, conditions: dict[str, Column], sample_rows: int = 1000) -> list[str]:
    """Names of the rules, most rejections per second first, estimated on about ``sample_rows`` rows of ``docs``
    (column text).  The order is greedy: each next rule is judged on what is left."""
    n = docs.count()
    if not n:
        return list(conditions)
    sample = cut(with_statistics(docs.sample(min(1.0, sample_rows / n), seed=5)).coalesce(1))

    def timed(*columns: Column) -> float:
        began = time.perf_counter()
        sample.select(*columns).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    timed(F.lit(1).alias("x"))
    reading = timed(F.length("__text").alias("x"))
    cost = {k: max(timed(c.alias("x")) - reading, 1e-3) for k, c in conditions.items()}
    # How often each set of rules holds together: at most 2^rules rows.
    sets = sample.select(*[F.coalesce(c, F.lit(False)).alias(k) for k, c in conditions.items()]).groupBy(*conditions).count().collect()
    order, left = [], list(conditions)
    while left:
        best = max(left, key=lambda k: sum(r["count"] for r in sets if r[k] and not any(r[o] for o in order)) / cost[k])
        order.append(best)
        left.remove(best)
    return order


def judge(docs: DataFrame, text_col: str = "text", sample_rows: int = 1000) -> DataFrame:
    """``docs`` with the base statistics, base_failed, failed_rule (the rule that rejected the text, which depends on
    the order; null if none) and kept.  Write the result before filtering it: a filter on a statistic is pushed down
    and computes it twice."""
    stats = with_statistics(docs, text_col)
    conditions = rules()
    order = order_rules(docs.select(F.col(text_col).alias("text")), conditions, sample_rows)
    verdict = F.when(base_failed(), "base")
    for name in order:
        verdict = verdict.when(conditions[name], name)
    out = stats.withColumn("base_failed", base_failed()).withColumn("failed_rule", verdict)
    return out.withColumn("kept", F.col("failed_rule").isNull()).drop("__text", "__words", "__letters")
