"""Best-fit packing of tokenised documents into sequences (operator 11).

``pieces`` tokenises each document, ends it with ``end_id`` and cuts what is
longer than a sequence.  ``pack`` places the pieces by best-fit decreasing: the
longest first, each into the open sequence with the least room that holds it,
found in a segment tree over remaining capacities in logarithmic time.
``sequences`` joins the ids of each sequence.

The decisions of best fit depend on lengths alone, of which there are at most
``capacity``, and sequences with equal room are alike.  So the tree's leaves
count the open sequences by room, and equal pieces are placed a class of
sequences at a time: a sequence of room r, once it has taken a piece of length
l, is the tightest for the next one, so each takes floor(r / l) of them in turn.
This is exactly what best fit does piece by piece, from a histogram of lengths:
the plan, a list of ``Placement``s, is bounded by the capacity and not by the
corpus (some thousand rows at 2048), and is all that the driver makes and sends.
Spark sorts the pieces by length and row key, numbers them, and each piece reads
its place off the plan by its number.

Tokenising: the vocabulary drops white space and case, so the ids of a text are
those of its words (split at ASCII white space) in turn, and the ids of up to
``KNOWN`` words a task are kept, without the stops and commas after them; others
are encoded each time, with equal ids.

Cases: a null or blank text is ``end_id`` alone; rows that repeat are packed
each; rows with a null id are packed like others; an empty table gives an empty
result.  Numbers of sequences are whole numbers from 0 without gaps; pieces of
equal length are ordered by row key, so reruns agree on any partitioning.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, row_key, text_or_empty
from .tokens import byte_texts

#: Words whose ids a task keeps, and the longest such word.
KNOWN, KNOWN_BYTES = 400_000, 48


class Placement(NamedTuple):
    """Pieces ``number`` and on, up to the next row's, ``each`` to a sequence from ``sequence`` on, there from ``offset`` on."""
    number: int
    length: int
    each: int
    sequence: int
    offset: int


class Rooms:
    """Segment tree that counts open sequences by remaining capacity."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.width)

    def add(self, room: int, n: int) -> None:
        at = room + self.width
        while at:
            self.tree[at] += n
            at //= 2

    def tightest(self, length: int) -> int | None:
        """The least room of at least ``length`` that an open sequence has."""
        at = length + self.width
        if not self.tree[at]:
            while at > 1 and (at % 2 or not self.tree[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.width:
                at = 2 * at if self.tree[2 * at] else 2 * at + 1
        return at - self.width


def best_fit(histogram: dict[int, int], capacity: int) -> list[Placement]:
    """Best-fit decreasing of ``histogram[length]`` pieces of each length, numbered from 0 in that order."""
    rooms, open_, plan, number, fresh = Rooms(capacity), defaultdict(list), [], 0, 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = rooms.tightest(length)
            if room is None:  # none is open that holds it: open as many as the rest of this length needs
                room, need = capacity, -(-left // (capacity // length))
                open_[room].append((fresh, need))
                rooms.add(room, need)
                fresh += need
            first, n = open_[room].pop()
            each = min(room // length, left)
            used = min(n, left // each)
            if used < n:
                open_[room].append((first + used, n - used))
            plan.append(Placement(number, length, each, first, capacity - room))
            rooms.add(room, -used)
            open_[room - each * length].append((first, used))
            rooms.add(room - each * length, used)
            number, left = number + each * used, left - each * used
    return plan


def _tokenised(vocabulary: str, capacity: int, end_id: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(vocabulary)
        model = tokenizer.model

        class Known(dict):
            def __missing__(self, word):
                bare = word.rstrip(b".,;:!?")
                if bare[-1:].isalpha() and len(bare) < len(word):  # the vocabulary parts letters and these marks
                    return self[bare] + self[word[len(bare):]]
                if word.isalpha() and word.islower():  # of ASCII letters: one piece for the model, with nothing to normalise
                    ids = array("I", [t.id for t in model.tokenize(word.decode())]).tobytes()
                else:
                    ids = array("I", tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()
                if len(self) < KNOWN and len(word) <= KNOWN_BYTES:
                    self[word] = ids
                return ids

        known, end, names = Known(), array("I", [end_id]).tobytes(), ["doc_id", "rk", "piece", "start", "length", "ids"]
        for batch in batches:
            row, piece, ids = [], [], []
            for k, text in enumerate(byte_texts(batch.column("text"))):
                parts = (text if b"<|" in text else text.lower()).split()  # of bytes: ASCII only; special tokens keep their case
                own = b"".join(map(known.__getitem__, parts)) + end
                for p, at in enumerate(range(0, len(own), 4 * capacity)):
                    row.append(k)
                    piece.append(p)
                    ids.append(own[at : at + 4 * capacity])
            piece = np.array(piece, np.int32)
            ids = pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), batch.column("rk").take(pa.array(row, pa.int64())), pa.array(piece),
                 pa.array(piece.astype(np.int64) * capacity), pa.array([len(x) // 4 for x in ids.to_pylist()], pa.int64()), ids], names=names)
    return run


def pieces(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, rk (row key), piece, start, length, ids (little-endian unsigned 32-bit)."""
    with open(tokenizer_file, encoding="utf-8") as f:  # sent with the plan: executors need no copy
        vocabulary = f.read()
    base = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("rk", row_key("doc_id", "text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(_tokenised(vocabulary, capacity, end_id), f"doc_id {kind}, rk long, piece int, start long, length long, ids binary")


def _placed(plan: list[Placement], starts: dict[int, int]):
    table, below = np.array(plan, np.int64).reshape(-1, 5), dict(starts)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            at = batch.column("__at").to_numpy()
            number = np.array([below[p] for p in (at >> 33).tolist()], np.int64) + (at & ((1 << 33) - 1))
            first, length, each, sequence, offset = table[np.searchsorted(table[:, 0], number, "right") - 1].T
            turn = number - first
            rest = batch.select([n for n in batch.schema.names if n != "__at"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(sequence + turn // each), pa.array(offset + turn % each * length)],
                                             names=[*rest.schema.names, "sequence_id", "offset"])
    return run


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` (rk, piece, length from 1 to capacity, any other columns) with sequence_id and offset."""
    pieces = cut(pieces)  # the sort reads it twice
    order = [F.col("length").desc(), "rk", "piece"]
    ranked = cut(pieces.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    # One row per length and partition at most, and a partition holds neighbouring lengths: capacity + partitions rows.
    counts = ranked.groupBy(F.shiftright("__at", 33).alias("part"), "length").agg(F.count("*").alias("n")).collect()
    histogram, of_part = defaultdict(int), defaultdict(int)
    for r in counts:
        histogram[r["length"]] += r["n"]
        of_part[r["part"]] += r["n"]
    starts, total = {}, 0
    for part in sorted(of_part):
        starts[part], total = total, total + of_part[part]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(_placed(best_fit(histogram, capacity), starts), f"{kinds}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, length, ids; ``packed`` with the ids of its pieces.  A group is one sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate("parts", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select("sequence_id", "length", joined.alias("ids"))
