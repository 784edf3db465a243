"""Periodic run detection by recompression (operator 13).

A *run* is a stretch of consecutive words with smallest period q, at least
``max(shortest, 2 q)`` words long, that neither neighbour extends with that
period.  The operator returns every run of every text, and the text with each
run collapsed to its first period.

*Grammar.*  The words of a chunk of texts, with a separator of its own between
two texts, are compressed by turns: block compression replaces each stretch of
equal neighbours by one symbol for (symbol, count), pair compression splits the
symbols in two classes by a hash and replaces each neighbouring pair of a left
and a right one.  Equal stretches of words get equal symbols but at their ends,
and a round leaves about three quarters, so the rounds are logarithmic and all
levels together hold a few nodes a word.  ``Grammar.extension`` tells how many
words are equal from two places on (or before them): it steps over equal
symbols, whole blocks at a time, climbs where both begin an equal larger symbol
and descends where symbols differ.  At the lowest level words are compared.

*Candidates.*  A run of period q holds a multiple i of q among its first q
words, and word i + q equals word i.  So all pairs (i, i + q), harmonic in
number (n log n), are compared first; those with three equal words after or
before are candidates, whose exact extensions the grammar gives (a run needs
six).  A stretch found with several periods has the smallest, as the others are
its multiples.  Periods are taken in rising order, and a candidate inside a run
whose period divides its own is that run again and is left out.

Every text is dealt with by itself, so the work is a map over rows: nothing is
shuffled, and a chunk holds ``CHUNK`` words or one longer text.  Words are
compared as themselves, not by hashes.

Cases: a null or blank text has no word, no run and an empty collapsed text;
rows that repeat give a row each; a null id is returned as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, memo, words
from .tokens import byte_texts, mix

#: Words in a chunk of texts, and words of the longest text whose grid is kept ready.
CHUNK = 1 << 17
READY = 1 << 16

RUNS = "runs array<struct<start:long,length:long,period:long>>, collapsed string"


class Grammar:
    """Run-length grammar of whole numbers; negative ones are separators, all different, first and last."""

    def __init__(self, sequence):
        self.levels = [(np.asarray(sequence, np.int64), None)]  # symbols, first child of each
        fresh, at = int(self.levels[0][0].max(initial=0)) + 1, 0
        while True:
            row = self.levels[-1][0]
            begins = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            if len(begins) < len(row):
                fresh = self._block(row, begins, fresh)
                row = self.levels[-1][0]
            begins = self._pairs(row, at)
            if begins is None:
                break
            fresh, at = self._pair(row, begins, fresh), at + 1
        self._link()

    def _named(self, row, begins, changed, key, fresh):
        """Append the level that begins at ``begins``; the changed symbols are named by their keys."""
        symbols = row[begins]
        names, which = np.unique(key, return_inverse=True)
        symbols[changed] = fresh + which
        self.levels.append((symbols, begins))
        return fresh + len(names)

    def _block(self, row, begins, fresh):
        count = np.diff(np.append(begins, len(row)))
        changed = count > 1
        return self._named(row, begins, changed, row[begins[changed]] * (len(row) + 1) + count[changed], fresh)

    def _pairs(self, row, at):
        """Whether a symbol is the right one of a pair, by the better of two classes; None if no pair is left."""
        joins = (row[:-1] >= 0) & (row[1:] >= 0)
        if not joins.any():
            return None
        while True:
            best = None
            for salt in (2 * at, 2 * at + 1):
                left = (mix(row.astype(np.uint64), 101 + salt) & np.uint64(1)).astype(bool)
                for pairs in (joins & left[:-1] & ~left[1:], joins & ~left[:-1] & left[1:]):
                    n = np.count_nonzero(pairs)
                    if best is None or n > best[0]:
                        best = n, pairs
            if best[0]:
                return best[1]
            at += 1 << 10

    def _pair(self, row, pairs, fresh):
        first = np.flatnonzero(pairs)
        begins = np.flatnonzero(~np.append(False, pairs))
        return self._named(row, begins, np.append(pairs, False)[begins], row[first] * fresh + row[first + 1], fresh)

    def _link(self):
        """Nodes of all levels in one numbering: symbol, words, parent, first and last child, equal neighbours."""
        lengths = [len(s) for s, _ in self.levels]
        base = np.concatenate([[0], np.cumsum(lengths)])
        n = int(base[-1])
        self.symbol = np.concatenate([s for s, _ in self.levels])
        self.size, self.parent = np.ones(n, np.int32), np.full(n, -1, np.int32)
        self.child = {1: np.full(n, -1, np.int32), -1: np.full(n, -1, np.int32)}
        self.outer = {1: np.zeros(n, bool), -1: np.zeros(n, bool)}
        self.equal = {1: np.ones(n, np.int32), -1: np.ones(n, np.int32)}
        for k, (row, begins) in enumerate(self.levels):
            lo, hi = int(base[k]), int(base[k + 1])
            edge = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            end = np.append(edge[1:], len(row))
            if len(edge) < len(row):
                place = np.arange(len(row))
                self.equal[1][lo:hi] = np.repeat(end, end - edge) - place
                self.equal[-1][lo:hi] = place - np.repeat(edge, end - edge) + 1
            if begins is None:
                continue
            below, width = int(base[k - 1]), lo - int(base[k - 1])
            ends = np.append(begins[1:], width)
            self.child[1][lo:hi], self.child[-1][lo:hi] = below + begins, below + ends - 1
            self.outer[1][below + begins] = self.outer[-1][below + ends - 1] = True
            self.parent[below:lo] = np.repeat(np.arange(lo, hi), ends - begins)
            self.size[lo:hi] = np.add.reduceat(self.size[below:lo], begins)

    def extension(self, x, y, way: int):
        """Number of equal words from places x and y on (way 1), or from them backwards (way -1)."""
        child, outer, equal = self.child[way], self.outer[way], self.equal[way]
        total = np.zeros(len(x), np.int64)
        at, x, y = np.arange(len(x)), np.asarray(x, np.int64), np.asarray(y, np.int64)
        while len(at):
            same = self.symbol[x] == self.symbol[y]
            up, vp = self.parent[x], self.parent[y]
            climb = same & outer[x] & outer[y] & (self.symbol[up] == self.symbol[vp])
            step = np.where(same & ~climb, np.minimum(equal[x], equal[y]), 0)
            total[at] += step * self.size[x]
            x, y = (np.where(climb, u, np.where(same, z + way * step, child[z])) for u, z in ((up, x), (vp, y)))
            going = x >= 0  # a word has no child: these differ
            at, x, y = at[going], x[going], y[going]
        return total


def _pairs_of(lo: int, hi: int, n: int):
    """(i, i + q) of all multiples i of q with lo <= q < hi and i + q < n."""
    q = np.arange(lo, hi, dtype=np.int64)
    count = (n - 1) // q
    period = np.repeat(q, count)
    number = np.arange(len(period)) - np.repeat(np.cumsum(count) - count, count)
    return number * period, (number + 1) * period


@memo
def _ready():
    """The grid of READY words in the order of i + q, so that a shorter text's is its beginning, and where that ends."""
    i, j = _pairs_of(1, READY // 2 + 1, READY)
    order = np.argsort(j, kind="stable")
    return i[order], j[order], np.searchsorted(j[order], np.arange(READY + 1))


def _grid(n: int):
    if n <= READY:
        i, j, end = _ready()
        yield i[: end[n]], j[: end[n]]
        return
    lo = 1
    while lo <= n // 2:
        yield _pairs_of(lo, min(2 * lo, n // 2 + 1), n)
        lo *= 2


def _candidates(text, begin: int, n: int):
    """Places i and periods q of a text's grid with three equal words after or before; ``text`` has separators around."""
    own = text[begin : begin + n]
    for i, j in _grid(n):
        hit = np.flatnonzero(own[i] == own[j])
        x, y = i[hit] + begin, j[hit] + begin
        ok = y - x <= n // 2
        x, y = x[ok], y[ok]
        after = (text[x + 1] == text[y + 1]) & (text[x + 2] == text[y + 2])
        before = (text[x - 1] == text[y - 1]) & (text[x - 2] == text[y - 2]) & (text[x - 3] == text[y - 3])
        ok = after | before
        yield x[ok], (y - x)[ok]


def _sequence(texts: list):
    """Word numbers of the texts with three separators before each and after the last, and where each begins."""
    number = {w: k for k, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
    out, begin, sep = [], [], -1
    for t in [*texts, None]:
        out += [sep, sep - 1, sep - 2]
        sep -= 3
        if t is not None:
            begin.append(len(out))
            out += map(number.__getitem__, t)
    return np.array(out, np.int64), begin


def runs_of(texts: list, shortest: int = 12) -> list:
    """For each text, a list of words, its runs as sorted rows (start, length, period)."""
    text, begin = _sequence(texts)
    found = [[np.concatenate(c) for c in zip(*_candidates(text, b, len(t)))] if len(t) >= shortest else [] for b, t in zip(begin, texts)]
    used = [k for k, f in enumerate(found) if len(f) and len(f[0])]
    out = [np.zeros((0, 3), np.int64) for _ in texts]
    if not used:
        return out
    if len(used) < len(texts):  # the grammar is made of the texts with candidates
        text, new = _sequence([texts[k] for k in used])
    else:
        new = begin
    x = np.concatenate([found[k][0] - begin[k] + b for k, b in zip(used, new)])
    q = np.concatenate([found[k][1] for k in used])
    grammar = Grammar(text)
    cover_end, cover_period = np.zeros(len(text), np.int64), np.ones(len(text), np.int64)
    rows, lo = [], 1
    while lo <= q.max():
        now = (q >= lo) & (q < 2 * lo) & ((cover_end[x] <= x + q) | (q % cover_period[x] > 0))
        u, p = x[now], q[now]
        ahead, back = grammar.extension(u, u + p, 1), grammar.extension(u - 1, u + p - 1, -1)
        n = ahead + back + p
        ok = n >= np.maximum(shortest, 2 * p)
        new_runs = np.unique(np.stack([u[ok] - back[ok], n[ok], p[ok]], 1), axis=0)
        for s, n, p in new_runs[new_runs[:, 1] >= 4 * new_runs[:, 2]]:
            cover_end[s : s + n], cover_period[s : s + n] = s + n, p
        rows.append(new_runs)
        lo *= 2
    rows = np.concatenate(rows)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    rows = rows[np.append(np.ones(min(len(rows), 1), bool), (rows[1:, :2] != rows[:-1, :2]).any(1))]  # of equal stretches, the smallest period
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    edge = np.searchsorted(rows[:, 0], [*new, len(text)])
    for k, b, lo, hi in zip(used, new, edge[:-1], edge[1:]):
        out[k] = rows[lo:hi] - np.array([b, 0, 0])
    return out


def _collapsed(text: list, runs) -> bytes:
    """The words of a text that no run holds after its first period."""
    if not len(runs):
        return b" ".join(text)
    depth = np.zeros(len(text) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([w for w, d in zip(text, np.cumsum(depth).tolist()) if not d])


def _find(shortest: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def done(ids, texts):
            runs = runs_of(texts, shortest)
            rows = np.concatenate(runs)
            ends = np.cumsum([0] + [len(r) for r in runs]).astype(np.int32)
            parts = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], names=["start", "length", "period"])
            collapsed = pa.array([_collapsed(t, r) for t, r in zip(texts, runs)], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(ends), parts), collapsed],
                                              names=["doc_id", "runs", "collapsed"])

        for batch in batches:
            lo, texts, n = 0, [], 0
            for k, t in enumerate(byte_texts(batch.column("text"))):
                t = t.split()  # of bytes: at space and the characters 9 to 13
                if texts and n + len(t) > CHUNK:
                    yield done(batch.column("doc_id").slice(lo, len(texts)), texts)
                    lo, texts, n = k, [], 0
                texts.append(t)
                n += len(t)
            if texts:
                yield done(batch.column("doc_id").slice(lo, len(texts)), texts)
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 12) -> DataFrame:
    """One row per row of ``docs``: doc_id, runs (start, length, period in words, sorted), collapsed."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(_find(shortest), f"doc_id {base.schema['doc_id'].dataType.simpleString()}, {RUNS}")


def with_planted_runs(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text, in one of ten documents by the crc32 h of its id with a period planted: with g = floor(h / 10), from
    word a = g % n on, word i becomes word a + (i - a) % p, where p = 1 + floor((n - a) / (3 + g % 8)).  A null id has none."""
    h, w = F.crc32(F.col(id_col).cast("string").cast("binary")), words(F.col(text_col))

    def planted(s):
        n = F.size(s["w"])
        a = (s["g"] % n).cast("int")
        p = 1 + F.floor((n - a) / (3 + s["g"] % 8)).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(s["w"], a + 1, p), F.floor(n / p).cast("int") + 1))
        return F.array_join(F.concat(F.slice(s["w"], F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & (F.size(w) > 0), let(F.struct(w.alias("w"), F.floor(h / 10).alias("g")), planted)).otherwise(F.col(text_col))
