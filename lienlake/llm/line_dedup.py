"""Near-duplicate lines by a deletion-neighbourhood join (operator 5).

Two lines are near duplicates when one unit inserted, deleted or replaced turns
one into the other.  The units of a line of at least ``fuzzy_words`` words are
its words; those of a shorter one are its characters (with one space between
words), if it has at least ``fuzzy_chars`` of them.  Lines shorter than that must
be equal, as an edit would be most of them; lines with different units must be
too.  White space besides doesn't matter.  ``edits`` 0 asks for equal lines only.
(More than one edit can't be done this way: the earliest line of a key could
fail where a later one holds.)  Every line with a word takes part.  Of the lines
that stand for each other the earliest is kept: a line goes if an equal or near
line comes before it, by document id, then line number.

Each line files itself under the hash of its units and under the hashes of all
sequences with one unit deleted.  An insertion or deletion makes one line's
whole hash equal a deletion of the other; a replacement makes both delete the
same place.  So within a key only the earliest whole line and the earliest
deletion (overall and per place) matter: groups are reduced to those and never
expanded into pairs.  What is found is verified on the units.

Before that, lines that can't have a near duplicate are set aside without
loss: one edit leaves the first or the last half of the units as it was, so
only lines that share a half with a different line emit their deletions.

Cases: a null or empty text has one empty line, which is left alone, as are all
lines without a word; rows with the same id and text are one document; ids are
whole numbers (others raise an error), null ids come after all others; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Among, among, cut, let, row_key, text_or_empty
from .tokens import Hasher, byte_texts, chunks, joined, mix, signed

_PLACE = "no_id boolean, doc_id long, rk long, line_no int"
_ORDER = ("no_id", "doc_id", "rk", "line_no")


def _char_units(lines: list, hasher: Hasher):
    """Hashes of the characters of short lines (one space between words), and where each line's begin and how many they are."""
    plain = [b" ".join(x.split()).decode() for x in lines]
    n = np.array([len(x) for x in plain], np.int64)
    points = np.frombuffer("".join(plain).encode("utf-32-le"), "<u4").astype(np.uint64)
    return mix(points, 77), np.cumsum(n) - n, n


def _halves(hasher: Hasher, h, first, n, salt: int):
    """Four hashes of each line: of its first and last half, as the shorter (or equal) line and as the longer one."""
    run, cols = hasher.running(h), []
    part = lambda a, b, place: mix(mix(hasher.stretch(run, a, b)) ^ (b - a).astype(np.uint64), salt + place)
    for tag in (n, n - 1):
        c = tag // 2
        of = mix(tag.astype(np.uint64), 5)
        cols += [part(first, first + c, 2) ^ of, part(first + n - (tag - c), first + n, 3) ^ of]
    return np.stack(cols, 1)


def _variants(hasher: Hasher, h, first, n, salt: int):
    """Keys of each line's whole and of its deletions, the deleted place (-1: none) and the line's number."""
    run, down = hasher.running(h), hasher.words.down
    # the units before the deleted one, and those after it moved one place to the front
    of = np.repeat(np.arange(len(n)), n)
    j = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(len(of))
    rest = (run[j] - run[first[of]]) + (run[(first + n)[of]] - run[j + 1]) * down[1]
    rest = rest * down[first[of]]
    key = np.concatenate((mix(hasher.stretch(run, first, first + n), salt) ^ n.astype(np.uint64), mix(rest, salt) ^ (n[of] - 1).astype(np.uint64)))
    return key, np.concatenate((np.full(len(n), -1), j - first[of])).astype(np.int32), np.concatenate((np.arange(len(n)), of))


def _line_keys(fuzzy_words: int, fuzzy_chars: int, edits: int):
    """(place, whole, halves) of every line that has a word."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hasher = Hasher(lower=False)
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            for lo, hi in chunks(texts):
                buf, begin = joined(texts[lo:hi])
                h, at, end = hasher.tokens(buf)
                feed = np.flatnonzero(np.frombuffer(buf, np.uint8) == 10)  # the last byte is one
                edge = np.concatenate(([0], np.searchsorted(at, feed)))
                n = np.diff(edge)
                doc = np.searchsorted(begin, feed, "right") - 1
                line = np.arange(len(feed)) - np.searchsorted(feed, begin)[doc]
                kept = np.flatnonzero(n)
                first, n, doc, line = edge[kept], n[kept], doc[kept], line[kept]
                whole = mix(mix(hasher.stretch(hasher.running(h), first, first + n)) ^ n.astype(np.uint64), 1)
                halves, has = np.zeros((len(n), 4), np.uint64), np.zeros(len(n), bool)
                if edits:
                    by_words = n >= fuzzy_words
                    short = np.flatnonzero(~by_words)
                    units, place, count = _char_units([buf[at[first[i]] : end[first[i] + n[i] - 1]] for i in short], hasher)
                    halves[by_words] = _halves(hasher, h, first[by_words], n[by_words], 0)
                    halves[short] = _halves(hasher, units, place, count, 50)
                    has = by_words
                    has[short] = count >= fuzzy_chars
                ends = np.concatenate(([0], np.cumsum(4 * has))).astype(np.int32)
                take = pa.array(lo + doc)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(take) for c in ("no_id", "doc_id", "rk")]
                    + [pa.array(line.astype(np.int32)), pa.array(signed(whole)), pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(halves[has].reshape(-1))))],
                    names=["no_id", "doc_id", "rk", "line_no", "whole", "halves"])
    return run


def _deletions(fuzzy_words: int):
    """(key, place of the deletion or -1 for the whole line, no) of each line."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hasher = Hasher(lower=False)
        for batch in batches:
            texts, no = byte_texts(batch.column("line")), batch.column("no")
            for lo, hi in chunks(texts, 1 << 18):
                buf, begin = joined(texts[lo:hi])
                h, at, _ = hasher.tokens(buf)
                edge = np.append(np.searchsorted(at, begin), len(h))
                first, n = edge[:-1], np.diff(edge)
                long, short = np.flatnonzero(n >= fuzzy_words), np.flatnonzero(n < fuzzy_words)
                by_words = _variants(hasher, h, first[long], n[long], 0)
                by_chars = _variants(hasher, *_char_units([texts[lo + i] for i in short], hasher), 50)
                for (key, place, of), lines in ((by_words, long), (by_chars, short)):
                    if len(key):
                        yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(place), no.take(pa.array(lo + lines[of]))], names=["key", "place", "no"])
    return run


def _within_one_edit(fuzzy_words: int):
    def units(line: bytes):
        w = line.split()
        return w if len(w) >= fuzzy_words else b" ".join(w).decode()

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if type(a) is not type(b) or len(b) - len(a) > 1:
            return False
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a[i + (len(a) == len(b)) :] == b[i + 1 :]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            a, b = (byte_texts(batch.column(c)) for c in ("line", "other"))
            kept = [i for i, (x, y) in enumerate(zip(a, b)) if near(units(x), units(y))]
            yield batch.select(["no", "keeper"]).take(pa.array(kept, pa.int64()))
    return run


_STEP = 0x5851F42D  # odd, so that the lines of a document differ in their spots' low bits


def _picked_lines(wanted: Among):
    """(rk, line_no, line) of the lines whose spot, their row key and number in one hash, is among the wanted ones."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = byte_texts(batch.column("text"))
            for lo, hi in chunks(texts):
                count = np.array([t.count(b"\n") + 1 for t in texts[lo:hi]], np.int64)
                doc = np.repeat(np.arange(lo, hi), count)
                line = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                spots = batch.column("rk").to_numpy()[doc] ^ (line * _STEP)
                at = pa.RecordBatch.from_arrays([pa.array(spots), pa.array(doc), pa.array(line.astype(np.int32))], names=["spot", "doc", "line_no"])
                at = wanted.of(at, "spot")
                lines, last, split = [], -1, []
                for d, i in zip(at.column("doc").to_pylist(), at.column("line_no").to_pylist()):
                    if d != last:
                        last, split = d, texts[d].split(b"\n")
                    lines.append(split[i])
                yield pa.RecordBatch.from_arrays([batch.column("rk").take(at.column("doc")), at.column("line_no"), pa.array(lines, pa.binary()).cast(pa.string())],
                                                 names=["rk", "line_no", "line"])
    return run


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fuzzy_words: int = 8,
                    fuzzy_chars: int = 8, edits: int = 1) -> DataFrame:
    """A row for each line that goes: doc_id, rk (row key), line_no (from 0), keep_doc_id, keep_line_no and edits
    (0 or 1) of the earliest line that it repeats."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    base = base.select(F.col("doc_id").isNull().alias("no_id"), "doc_id", row_key("doc_id", "text").alias("rk"), "text")
    if edits not in (0, 1):
        raise ValueError("edits must be 0 or 1")
    lines = cut(base.mapInArrow(_line_keys(fuzzy_words, fuzzy_chars, edits), _PLACE + ", whole long, halves array<long>"))
    # a row key may stand for several equal rows, which have the same lines
    lines = lines.withColumn("at", F.struct(*_ORDER))
    least = cut(lines.groupBy("whole").agg(F.min("at").alias("at"), F.max("at").alias("last"), F.max("halves").alias("halves")))
    near = _near_keepers(base, least, fuzzy_words)
    gone = least.join(near, "whole", "left").filter("keeper is not null or at <> last")
    gone = cut(gone.select("whole", F.col("at").alias("first"), "keeper"))  # the join's own shuffles, which Spark can split
    found = lines.select("whole", "at").join(gone, "whole").filter("keeper is not null or at <> first")
    keep = F.least(F.col("first"), F.col("keeper"))
    same = F.col("at") != F.col("first")
    edits = F.when(F.col("keeper").isNull() | (same & (F.col("first") < F.col("keeper"))), 0).otherwise(1)
    return found.select("at.doc_id", "at.rk", "at.line_no", keep["doc_id"].alias("keep_doc_id"),
                        keep["line_no"].alias("keep_line_no"), edits.alias("edits")).distinct()


def _near_keepers(base: DataFrame, least: DataFrame, fuzzy_words: int) -> DataFrame:
    """(whole, keeper): for lines with an earlier line at one edit, where the earliest such line stands.  What lines share
    is told by an aggregation, which counts before it shuffles, and a join, whose hot keys Spark can split."""
    halves = least.filter("size(halves) > 0").select("whole", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("whole").alias("w0"), F.max("whole").alias("w1")).filter("w0 <> w1").select("half")
    met = halves.join(shared, "half", "left_semi").select("whole").distinct()
    # Lines are told by numbers that grow with their place: a key costs 20 bytes, and the earliest line is the least number.
    placed = cut(least.join(met, "whole").select("whole", "at").orderBy("at").withColumn("no", F.monotonically_increasing_id()))
    # The lines are picked from the texts where these are read; rows that share a row key give a line several times.
    spots = placed.select("no", "at.rk", "at.line_no", F.col("at.rk").bitwiseXOR(F.col("at.line_no").cast("long") * _STEP).alias("spot"))
    picked = base.select("rk", "text").mapInArrow(_picked_lines(Among(spots, "spot")), "rk long, line_no int, line string")
    picked = picked.groupBy("rk", "line_no").agg(F.min("line").alias("line"))
    lines = cut(picked.join(spots, ["rk", "line_no"]).select("no", "line"))
    filed = cut(lines.mapInArrow(_deletions(fuzzy_words), "key long, place int, no long"))
    whole_line = F.min(F.when(F.col("place") < 0, F.col("no"))).alias("f")
    deletion = F.min(F.when(F.col("place") >= 0, F.col("no"))).alias("d")
    by_key = filed.groupBy("key").agg(whole_line, deletion, F.max("no").alias("last")).filter("least(f, d) <> last").drop("last")
    by_key = cut(by_key)
    met = cut(among(filed, "key", by_key.select("key")).join(by_key, "key"))
    deleted = met.filter("place >= 0")
    by_place = deleted.groupBy("key", "place").agg(F.min("no").alias("p"), F.max("no").alias("last")).filter("p <> last").drop("last")
    first = met.select("no", F.when(F.col("place") < 0, F.col("d")).otherwise(F.col("f")).alias("keeper"))
    same = deleted.join(by_place, ["key", "place"]).select("no", F.col("p").alias("keeper"))
    pairs = first.union(same).filter("keeper < no").distinct()
    pairs = pairs.join(lines, "no").join(lines.select(F.col("no").alias("keeper"), F.col("line").alias("other")), "keeper")
    ok = pairs.select("no", "keeper", "line", "other").mapInArrow(_within_one_edit(fuzzy_words), "no long, keeper long")
    found = ok.groupBy("no").agg(F.min("keeper").alias("keeper")).join(placed.select("no", "whole"), "no")
    return found.select("whole", "keeper").join(placed.select(F.col("no").alias("keeper"), "at"), "keeper").select("whole", F.col("at").alias("keeper"))


def _without(text: Column, gone: Column) -> Column:
    """A text without the lines of these numbers."""
    def rest(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    return let(F.split(text, "\n", -1), rest)


def drop_duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
                         **options) -> DataFrame:
    """``docs`` with the lines that repeat an earlier line cut out, and without the documents of which no line with
    a word is left; their n_chars is counted anew.  Other documents are returned as they were."""
    gone = duplicate_lines(docs, id_col, text_col, **options).groupBy(F.col("rk").alias("__rk")).agg(F.collect_set("line_no").alias("__gone"))
    key = F.xxhash64(F.col(id_col).cast("long"), text_or_empty(text_col))
    out = docs.join(gone, key == F.col("__rk"), "left")
    out = out.withColumn("__text", F.when(F.col("__gone").isNotNull(), _without(F.col(text_col), F.col("__gone"))))
    out = out.filter(r"__text is null or __text rlike '[^\\x20\\x09-\\x0D]'")
    new = {text_col: F.coalesce(F.col("__text"), F.col(text_col))}
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        new[chars_col] = F.when(F.col("__text").isNull(), F.col(chars_col)).otherwise(F.length("__text").cast(kind))
    return out.select([new[c].alias(c) if c in new else F.col(c) for c in docs.columns])
