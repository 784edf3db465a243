"""Licence statements through a positional rare-token index (operator 10).

The licence templates are indexed by word: for each word, the templates and the
places where they have it.  A template whose mandatory phrases all stand in the
file is looked up with its own words of highest IDF that the file has, where the
IDF is counted over the whole corpus.  Each occurrence votes for the template at a
relative position (its place less the template's), and the words at every position
voted for are compared.  A template is accepted if they agree with it well enough.

So many words are looked up that they and the words that the file lacks fill more
of the template's places than may disagree.  Where the template is accepted one of
them agrees, so no such position goes without a vote, whatever else is in the file.

Templates are a fixed, short list, so their index is a literal in the plan.  A
file's words are looked up in the row itself; only the document counts of the
licence words (one row for each) are aggregated and joined.  A file that lacks
a word of every template's mandatory phrases can match none and is not looked up.

Cases: a null text is empty and has no words; an empty table gives an empty
result; rows are judged one by one, so repeated ids do not matter; ties between
words of equal IDF go to the word that sorts first, ties between positions to
the earlier one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, text_or_empty, words

#: What separates words: ASCII characters other than letters and digits, after lower-casing.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Licence notices as their publishers ask to state them, by label, with the phrases that must stand.
TEMPLATES = {
    "apache-2.0": ("licensed under the apache license version 2 0 the license you may not use this file except in compliance "
                   "with the license you may obtain a copy of the license at", ("apache license version 2 0",)),
    "apache-2.0-notice": ("licensed under the apache license version 2 0", ("apache license version 2 0",)),
    "gpl-2.0": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
                "license as published by the free software foundation version 2", ("gnu general public license", "version 2")),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    "gpl-3.0-or-later": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                         "public license as published by the free software foundation either version 3 of the license or at your "
                         "option any later version", ("gnu general public license", "any later version")),
    "lgpl-3.0": ("licensed under the gnu lesser general public license version 3", ("gnu lesser general public license",)),
    "mit-notice": ("released under the mit license", ("mit license",)),
    "mit-text": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                 "documentation files the software to deal in the software without restriction",
                 ("permission is hereby granted free of charge", "without restriction")),
    "bsd-3-clause": ("redistribution and use in source and binary forms with or without modification are permitted provided that "
                     "the following conditions are met neither the name of the copyright holder",
                     ("redistribution and use in source and binary forms", "neither the name")),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
            ("permission to use copy modify and or distribute this software",)),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    "cc-by-4.0": ("licensed under cc by 4 0", ("cc by 4 0",)),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    "unlicense": ("this is free and unencumbered software released into the public domain",
                  ("free and unencumbered software", "public domain")),
}


def _strings(items) -> Column:
    return F.array(*[F.lit(x) for x in items])


def _places(w: Column, phrase: str) -> Column:
    """Where a phrase's words stand consecutively in an array of words."""
    parts = phrase.split(" ")
    here = lambda i: _all([F.get(w, i + j) == p for j, p in enumerate(parts)])
    starts = F.sequence(F.lit(0), F.size(w) - len(parts))
    none = F.array().cast("array<int>")
    # a text without the phrase's first word has none
    return F.when((F.size(w) >= len(parts)) & F.array_contains(w, parts[0]), F.filter(starts, here)).otherwise(none)


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return F.coalesce(out, F.lit(False))


def _agreement(w: Column, by_idf: Column, template: str, phrases: tuple[str, ...], least: float) -> Column:
    """Share of a template's words that stand in the file at the template's best relative position; 0 if a mandatory
    phrase is missing, and exact if it is ``least`` or more.  ``by_idf``: the file's licence words, rarest first."""
    own = template.split(" ")
    enough = len(own) + 1 - min(n for n in range(len(own) + 1) if n / len(own) >= least)
    postings = {}
    for place, word in enumerate(own):
        postings.setdefault(word, []).append(place)
    index = F.create_map(*[c for k, v in postings.items() for c in (F.lit(k), F.array(*[F.lit(p) for p in v]))])
    times = F.create_map(*[c for k, v in postings.items() for c in (F.lit(k), F.lit(len(v)))])

    def looked_up(has: Column) -> Column:
        # the rarest words, until they and the missing ones fill ``enough`` places
        lacks = F.lit(len(own)) - F.aggregate(has, F.lit(0), lambda a, x: a + F.element_at(times, x))
        start = F.struct(lacks.alias("filled"), F.array().cast("array<string>").alias("of"))
        more = lambda a, x: F.struct((a["filled"] + F.element_at(times, x)).alias("filled"), F.concat(a["of"], F.array(x)).alias("of"))
        return F.aggregate(has, start, lambda a, x: F.when(a["filled"] < enough, more(a, x)).otherwise(a))["of"]

    def votes_of(rare: Column) -> Column:
        # relative positions of the looked-up words' occurrences
        at = F.filter(F.transform(w, lambda x, i: F.when(F.array_contains(rare, x), F.struct(x.alias("w"), i.alias("i")))),
                      lambda x: x.isNotNull())
        return F.flatten(F.transform(at, lambda x: F.transform(F.element_at(index, x["w"]), lambda p: x["i"] - p)))
    votes = let(let(F.array_intersect(by_idf, _strings(postings)), looked_up), votes_of)

    def best(v: Column) -> Column:
        # distinct positions with the words that agree there, over the whole template
        agree = lambda d: F.aggregate(F.transform(_strings(own), lambda x, j: (F.get(w, F.when(d + j >= 0, d + j)) == x)),
                                      F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(False)).cast("int"))
        return F.coalesce(F.array_max(F.transform(F.array_distinct(v), agree)), F.lit(0))
    must = [F.size(_places(w, p)) > 0 for p in phrases]
    share = let(votes, best).cast("double") / len(own)
    return F.when(_all(must), share).otherwise(F.lit(0.0))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.6) -> DataFrame:
    """One row per row: doc_id, n_words, n_base, first_word, last_word (places of the base phrases), base_labels,
    labels (the accepted templates' too) as sorted arrays, and score, the best agreement of an accepted template."""
    vocabulary = sorted({w for t, _ in TEMPLATES.values() for w in t.split(" ")})
    must = sorted({p.split(" ")[0] for _, phrases in TEMPLATES.values() for p in phrases})
    rows = docs.select(F.col(id_col).alias("doc_id"), F.lower(text_or_empty(text_col)).alias("text"))
    rows = rows.withColumn("w", words(F.col("text"), NOT_WORD))
    seen = F.array_intersect("w", _strings(vocabulary))
    rows = rows.select("doc_id", F.size("w").cast("long").alias("n_words"), "w", seen.alias("seen"))
    # document counts of the licence words over the whole corpus: at most one row for each word
    counts = rows.select(F.explode("seen").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    order = counts.agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "word"))), lambda x: x["word"]).alias("by_idf"))
    by_idf = F.coalesce(order.scalar(), F.array().cast("array<string>"))
    base = {label: _places(F.col("w"), phrase) for phrase, label in BASE.items()}
    rows = rows.select("doc_id", "n_words", "w", F.array_intersect(by_idf, F.col("seen")).alias("by_idf"),
                       F.arrays_overlap("seen", _strings(must)).alias("may"), *[c.alias(f"b_{i}") for i, c in enumerate(base.values())])
    places = F.concat(*[F.col(f"b_{i}") for i in range(len(base))])
    base_labels = F.filter(F.array(*[F.when(F.size(f"b_{i}") > 0, k) for i, k in enumerate(base)]), lambda x: x.isNotNull())
    shares = F.array(*[F.struct(F.lit(k).alias("label"), _agreement(F.col("w"), F.col("by_idf"), t, p, least).alias("share"))
                       for k, (t, p) in TEMPLATES.items()])
    accepted = F.filter(shares, lambda x: x["share"] >= least)
    none = F.array().cast("array<struct<label:string,share:double>>")
    rows = rows.select("doc_id", "n_words", places.alias("places"), base_labels.alias("base"),
                       F.when(F.col("may"), accepted).otherwise(none).alias("accepted"))
    return rows.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                       F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
                       F.array_sort(F.array_distinct("base")).alias("base_labels"),
                       F.array_sort(F.array_union("base", F.transform("accepted", lambda x: x["label"]))).alias("labels"),
                       F.coalesce(F.array_max(F.transform("accepted", lambda x: x["share"])), F.lit(0.0)).alias("score"))
