"""N-gram Jaccard join by universe partition and pigeonhole (operator 8).

Two documents link when their sets of word shingles have a Jaccard similarity
of at least ``threshold``; the operator returns the links' components.

Sets in a size band have a symmetric difference of at most H.  The universe of
shingles is hashed into T shares; a *plain* segment holds one share, a *deep*
segment two.  A plain segment asks for equality (it accounts for one
difference), a deep one for a difference of at most one shingle, found through
the segment's one-deletion neighbourhood (it accounts for two).  By the
pigeonhole principle T = H + 1 shares leave one segment that answers.  A
set may leave out its first ``spare`` empty plain segments, which would match
nearly everything; T grows by ``spare`` to make up for them.  ``allocate``
chooses the number of deep segments and spare shares of a band by cost: keys
written against sets that are expected to meet by accident.  In bands without
deep segments T is larger by SHARED - 1, so that linked sets share at least
SHARED keys there; in the others they are sure of one key only.  A key's lowest
bit tells which: it is 1 if the key alone makes its sets candidates; its highest
six bits are the band.

A segment of one or two shingles that many texts have brings strangers together,
more the larger the table.  So in bands without deep segments T grows by
``left_out`` more, and each set leaves out so many of its keys, those filed most
often.  The order is the same for all sets: the i-th of the keys that two sets
share stands i-th or later in either's own order, so the pair loses the first
``left_out`` of them at most and still shares SHARED.  (The same holds for empty
segments, in the order of their numbers.)

Sets that share a key are candidates.  The pairs of a group of up to ``SMALL``
sets are written out and counted; those that share enough keys are held against
each other by fingerprints: the shingles hashed into cells, of which those that
differ are a lower bound of the difference.  What may still link is compared
exactly.  (A linked pair that shares too few keys of small groups shares one of
a larger group.)

A larger group is gathered around a leader L, its member that stands in most
such groups, so that groups of the same family share theirs.  Of a cluster, the
members of all groups with the same leader, up to ``CLUSTER`` sets are held
against each other by fingerprints in one task.  Most clusters are sets that
share some common passage, with few near pairs, which are compared exactly.  Of
a family of near copies it returns each set's nearest pair first; once those are
compared, the pairs of different components that may still link follow.

A larger cluster, such as thousands of near copies, is never expanded into its
pairs.  Every member x is compared with L exactly.  For two members x and y that
don't both link with L, with a = shingles added to L and r = shingles of L that
are missing,

    |x ^ y| = a_x + a_y - 2 * common additions + |difference of what is missing|

so either they share an added shingle - then (L, shingle) is a key of the next
round, whose leader comes later in that order, so rounds end - or
a_x + a_y + |r_x - r_y| <= H(x, y), which needs one that lacks more of L than
it adds; those are joined on L and on how much they need or allow.  A linked
pair misses at most (1 - threshold) of either set, so that many additions and
one more, in hash order, are enough to meet.  No link is lost.

Cases: a null or blank text has no shingles and links with nothing; a text of
fewer words than a shingle is one shingle; equal sets are one node from the
start; rows with the same id are nodes of their own, tied only by similarity;
a null id has the component of its equals (null if none has an id); an empty
table gives an empty result.  Shingles are compared as 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Among, among, cut, row_key, text_or_empty
from .components import components, joined_components
from .tokens import Hasher, byte_texts, chunks, joined, mix, signed

#: Ratio between the sizes at which bands end.
BAND = 1.6

#: Linked sets share so many plain segments at least.
SHARED = 3

#: Bands in which linked sets differ in so many shingles at most may have deep segments.
DEEP = 32

#: The pairs of groups of up to SMALL sets are written out; larger groups are gathered around leaders, clusters of up
#: to CLUSTER sets compared by fingerprints, and larger ones solved through what members add to their leader.
SMALL, CLUSTER = 16, 4000

#: Pairs a set in a cluster that are compared at once.
FEW = 1


def shingle_sets(hasher: Hasher, texts: list, k: int) -> list:
    """Sorted distinct shingle hashes of each text of a chunk."""
    buf, begin = joined(texts)
    h, at, _ = hasher.tokens(buf)
    run = hasher.running(h)
    edge = np.append(np.searchsorted(at, begin), len(h))
    first = np.arange(max(len(h) - k + 1, 0))
    windows = mix(hasher.stretch(run, first, first + k))
    out = []
    for lo, hi in zip(edge[:-1], edge[1:]):
        if hi - lo >= k:
            out.append(np.unique(windows[lo : hi - k + 1]))
        elif hi > lo:
            out.append(mix(hasher.stretch(run, np.array([lo]), np.array([hi])), hi - lo))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def most_different(x: int, y: int, threshold: int) -> int:
    """Largest symmetric difference of linked sets of these sizes; threshold in per cent."""
    return (100 - threshold) * (x + y) // (100 + threshold)


def band_of(size: int) -> int:
    """Number of the size band; band b holds sizes from band_start(b) to band_start(b + 1) - 1."""
    b = max(int(math.log(size, BAND)) - 1, 0)
    while band_start(b + 1) <= size:
        b += 1
    return b


def band_start(b: int) -> int:
    return math.ceil(BAND**b)


def left_out(b: int, threshold: int) -> int:
    """How many of its keys a set leaves out in a band without deep segments."""
    hi = band_start(b + 1) - 1
    return 3 * (most_different(hi, hi, threshold) + 1) // 20


def allocate(b: int, threshold: int) -> tuple[int, int, int]:
    """(plain segments, deep segments, spare shares) of a band, by least cost.

    Keys cost 1 each, a deep segment one more for every shingle in it; an empty plain segment beyond the spare
    ones, or a segment of one shingle, costs ``meet`` keys for the strangers that it brings together.  Sets that may
    differ in ``DEEP`` shingles or more have no deep segments; without any there are ``left_out`` more plain ones."""
    meet = 40.0
    lo, hi = band_start(b), band_start(b + 1) - 1
    size, need, best = (lo + hi) / 2, most_different(hi, hi, threshold) + 1, None
    for spare in range(0, 13):
        for deep in range(0, min((need + spare) // 2, 4 * (need <= DEEP)) + 1):
            total = need + spare + (0 if deep else SHARED - 1)
            share = size / total
            empty = math.exp(-share)
            plain = total - 2 * deep
            expect = plain * empty
            over = sum((i - spare) * math.exp(-expect) * expect**i / math.factorial(i) for i in range(spare + 1, spare + 30))
            alone = plain * share * empty * 0.02 + deep * 2 * share * math.exp(-2 * share)
            cost = plain + deep * (1 + 2 * share) + meet * (over + alone)
            if best is None or cost < best[0] - 1e-9:
                best = (cost, plain, deep, spare)
    _, plain, deep, spare = best
    return (plain, deep, spare) if deep else (plain + left_out(b, threshold), deep, spare)


def keys_of(shingles, b: int, plan: tuple[int, int, int]):
    """The keys under which a set is filed in band b, which their highest six bits tell; their lowest bit is 1 if the band
    has deep segments."""
    plain, deep, spare = plan
    share = mix(shingles, 11 + b) % np.uint64(plain + 2 * deep)
    code = mix(shingles, 23)
    segment = np.where(share < 2 * deep, share // np.uint64(2), share - np.uint64(deep)).astype(np.int64)
    order = np.argsort(segment, kind="stable")
    count = np.bincount(segment, minlength=plain + deep)
    run = np.zeros(len(code) + 1, np.uint64)
    np.cumsum(code[order], out=run[1:])
    end = np.cumsum(count)
    total = run[end] - run[end - count]
    number = np.arange(plain + deep, dtype=np.uint64)
    place = mix(number, 1000 + b)
    empty = np.flatnonzero((count == 0) & (number >= deep))
    kept = np.ones(plain + deep, bool)
    kept[empty[:spare]] = False
    found = [mix(total[kept] ^ place[kept])]
    if deep:
        inside = segment < deep
        at = segment[inside]
        found.append(mix((total[at] - code[inside]) ^ place[at]))
    return np.unique(np.concatenate(found) >> np.uint64(6) & ~np.uint64(1) | np.uint64(deep > 0) | np.uint64(b << 58))


def fingerprint(shingles, threshold: int) -> bytes:
    """Half a byte for each of 2^i cells (2 at least): the sum of the codes of the shingles there.  There are more than
    1.5 to 3 cells for each shingle that linked sets may differ in: n/4 to n/2 at 85 per cent and over, twice as many below."""
    cells = 1 << max((len(shingles) - 1).bit_length() - 2 + max((100 - threshold) // 16, 0), 1)
    at = (mix(shingles, 41) % np.uint64(cells)).astype(np.int64)
    sums = np.bincount(at, mix(shingles, 43) % np.uint64(16), cells).astype(np.int64) & 15
    return (sums[0::2] | sums[1::2] << 4).astype(np.uint8).tobytes()


def _folded(prints):
    """Fingerprints of twice as many cells, folded onto half as many."""
    half = prints.shape[-1] // 2
    x, y = prints[..., :half], prints[..., half:]
    return ((x & 15) + (y & 15) & 15) | ((x & 240) + (y & 240) & 240)


#: In how many of their two cells bytes with this exclusive or differ.
_APART = np.array([(b % 16 > 0) + (b > 15) for b in range(256)], np.uint8)


def _cells_apart(prints, other):
    return _APART[prints ^ other].sum(-1, dtype=np.int64)


def _may_link(threshold: int):
    """Pairs whose fingerprints differ in no more cells than linked sets can."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            kept = []
            columns = [batch.column(c).to_pylist() for c in ("print", "other", "n", "m")]
            for i, (x, y, n, m) in enumerate(zip(*columns)):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                while len(x) != len(y):
                    x, y = (_folded(x), y) if len(x) > len(y) else (x, _folded(y))
                if _cells_apart(x, y) <= most_different(n, m, threshold):
                    kept.append(i)
            yield batch.select(["sid", "leader"]).take(pa.array(kept, pa.int64()))
    return run


_NEAR = "sid long, leader long, cluster long, left boolean"


def _near_in_cluster(threshold: int, all_pairs: bool):
    """Pairs of a cluster (sid, n, print, part) of different parts that may link by their sizes and fingerprints.

    If not ``all_pairs`` and there are more than ``FEW`` a set, such as in a family of near copies, only the nearest of
    those before it by size for each set, and each set with itself that is near a later one; ``left`` tells that."""
    def run(members):
        import pandas as pd

        members = members.sort_values(["n", "sid"])
        sid, n, part = (members[c].to_numpy() for c in ("sid", "n", "part"))
        cells = members["print"].map(len).to_numpy()
        by = {c: np.stack([np.frombuffer(x, np.uint8) for x in members["print"][cells == c]]) for c in np.unique(cells)}
        first = {c: int(np.argmax(cells == c)) for c in by}  # sizes grow, so equal lengths stand together
        x, y, found, room = [], [], 0, math.inf if all_pairs else FEW * len(sid)
        least, nearest, met = np.full(len(sid), np.iinfo(np.int64).max), np.arange(len(sid)), np.zeros(len(sid), bool)
        for i in range(len(sid)):
            mine = by[cells[i]][i - first[cells[i]]]
            for c, prints in by.items():
                lo = max(i + 1, first[c])
                hi = min(int(np.searchsorted(n, n[i] * 100 // threshold, "right")), first[c] + len(prints))
                if c < cells[i] or lo >= hi:
                    continue
                theirs = prints[lo - first[c] : hi - first[c]]
                while theirs.shape[1] > len(mine):
                    theirs = _folded(theirs)
                apart = _cells_apart(theirs, mine)
                near = (apart <= (100 - threshold) * (n[i] + n[lo:hi]) // (100 + threshold)) & (part[lo:hi] != part[i])
                at = np.flatnonzero(near)
                if len(at):
                    closer = at[apart[at] < least[lo + at]]
                    least[lo + closer], nearest[lo + closer], met[i] = apart[closer], i, True
                    found += len(at)
                    if found <= room:
                        x.append(np.full(len(at), i))
                        y.append(lo + at)
        left = found > room
        if left:
            later = np.flatnonzero(nearest != np.arange(len(sid)))
            x, y = [nearest[later], np.flatnonzero(met)], [later, np.flatnonzero(met)]
        x, y = (sid[np.concatenate(z)] if z else np.zeros(0, np.int64) for z in (x, y))
        return pd.DataFrame({"sid": np.maximum(x, y), "leader": np.minimum(x, y), "cluster": members["leader"].iloc[0], "left": left})
    return run


def _describe(k: int, threshold: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hasher = Hasher()
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            size, sid, prints = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.uint64), []
            for lo, hi in chunks(texts):
                for i, s in enumerate(shingle_sets(hasher, texts[lo:hi], k), lo):
                    size[i], sid[i] = len(s), mix(mix(s, 3).sum(dtype=np.uint64), len(s))
                    prints.append(fingerprint(s, threshold) if len(s) else b"")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("rk"), pa.array(size), pa.array(signed(sid)),
                                              pa.array(prints, pa.binary())], names=["doc_id", "rk", "n_shingles", "sid", "print"])
    return run


def _file(k: int, threshold: int, filing):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hasher, plans, seen = Hasher(), {}, set()
        for batch in batches:
            batch = filing.of(batch, "rk")
            texts = byte_texts(batch.column("text"))
            for lo, hi in chunks(texts):
                keys, sids = [], []
                for s in shingle_sets(hasher, texts[lo:hi], k):
                    sid = int(mix(mix(s, 3).sum(dtype=np.uint64), len(s)))
                    if not len(s) or sid in seen:  # an equal set of this task has been filed
                        continue
                    seen.add(sid)
                    b = band_of(len(s))
                    for band in (b, b + 1):
                        if band > b and 100 * len(s) < threshold * band_start(band):
                            continue  # nothing there is small enough to link with it
                        if band not in plans:
                            plans[band] = allocate(band, threshold)
                        found = keys_of(s, band, plans[band])
                        keys.append(found)
                        sids.append(np.full(len(found), sid, np.uint64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(keys))), pa.array(signed(np.concatenate(sids)))],
                                                     names=["key", "sid"])
    return run


def _sets(k: int, wanted):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hasher = Hasher()
        for batch in batches:
            batch = wanted.of(batch, "rk")
            texts = byte_texts(batch.column("text"))
            for lo, hi in chunks(texts):
                sets = shingle_sets(hasher, texts[lo:hi], k)
                sids = np.array([mix(mix(s, 3).sum(dtype=np.uint64), len(s)) for s in sets], np.uint64)
                ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rk").slice(lo, hi - lo), pa.array(signed(sids)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(np.concatenate(sets))))],
                    names=["rk", "sid", "shingles"])
    return run


def _several(filed: DataFrame, *key: str, by: str) -> DataFrame:
    """Keys under which rows of two or more values of ``by`` are filed, and their rows' number: counted before the
    shuffle, so that a key of very many rows is a few rows of every task."""
    counted = filed.groupBy(*key).agg(F.count("*").alias("size"), F.min(by).alias("p0"), F.max(by).alias("p1"))
    return counted.filter("p0 <> p1").drop("p0", "p1")


def _rarer(keyed: DataFrame, sized: DataFrame, threshold: int) -> DataFrame:
    """(key, sid) without the keys that are left out: of each set and band, those of the largest size."""
    plans = {b: allocate(b, threshold) for b in range(40)}
    number = F.array(*[F.lit(0 if plans[b][1] else left_out(b, threshold)) for b in plans])
    band = F.shiftrightunsigned("key", 58).cast("int")
    place = F.row_number().over(Window.partitionBy("sid", band).orderBy(F.desc("size"), "key"))
    met = keyed.join(sized, "key").withColumn("place", place)
    return met.filter(F.col("place") > F.coalesce(F.get(number, band), F.lit(0))).select("key", "sid")


def _led(crowd: DataFrame, *key: str) -> DataFrame:
    """Members (sid, turn, leader) of keys; the leader is the member with the least turn."""
    first = crowd.groupBy(*key).agg(F.min(F.struct("turn", "sid"))["sid"].alias("leader"))
    return crowd.join(first, [*key]).select("sid", "turn", "leader").distinct()


def _worth() -> Column:
    return F.when(F.col("key").bitwiseAND(F.lit(1)) == 1, SHARED).otherwise(1)


def _pairs_of_small(groups: DataFrame, *key: str) -> DataFrame:
    """The pairs (sid, leader), leader the smaller, of different parts in groups of up to SMALL rows."""
    members = groups.filter(F.col("size") <= SMALL).groupBy(*key).agg(F.sort_array(F.collect_set(F.struct("sid", "part"))).alias("of"))
    worth = _worth() if key == ("key",) else F.lit(SHARED)
    pairs = F.flatten(F.transform("of", lambda x, i: F.transform(
        F.filter(F.slice("of", i + 2, SMALL), lambda y: y["part"] != x["part"]),
        lambda y: F.struct(y["sid"].alias("sid"), x["sid"].alias("leader")))))
    met = members.select(worth.alias("worth"), F.inline(pairs)).groupBy("sid", "leader").agg(F.sum("worth").alias("worth"))
    return met.filter(F.col("worth") >= SHARED).select("sid", "leader")


def _linked(n_x: Column, n_y: Column, both: Column, threshold: int) -> Column:
    return both * 100 >= F.lit(threshold) * (n_x + n_y - both)


def _compare(pairs: DataFrame, sets: DataFrame, threshold: int, *more: str) -> DataFrame:
    """For pairs (sid, leader, more columns): sizes n and m, the shingles that both have, and whether they link; the set
    itself and its leader's remain as ``shingles`` and ``of_leader``."""
    x = pairs.join(among(sets, "sid", pairs.select("sid")), "sid")
    y = among(sets, "sid", pairs.select(F.col("leader").alias("sid"))).select(F.col("sid").alias("leader"), F.col("shingles").alias("of_leader"))
    both = F.size(F.array_intersect("shingles", "of_leader")).cast("long")
    return (x.join(y, "leader")
            .select("sid", "leader", *more, F.size("shingles").cast("long").alias("n"), F.size("of_leader").cast("long").alias("m"),
                    both.alias("both"), "shingles", "of_leader")
            .withColumn("linked", _linked(F.col("n"), F.col("m"), F.col("both"), threshold)))


def similarity_links(keyed: DataFrame, prints: DataFrame, sets_of, threshold: int) -> DataFrame:
    """The components (node, root) of all links.  ``keyed``: (key, sid); ``prints``: (sid, n, print), one per set;
    ``sets_of``: from a table of sids to their (sid, shingles)."""
    def likely(pairs: DataFrame) -> DataFrame:
        x = among(prints, "sid", pairs.select("sid"))
        y = among(prints, "sid", pairs.select(F.col("leader").alias("sid")))
        y = y.select(F.col("sid").alias("leader"), F.col("n").alias("m"), F.col("print").alias("other"))
        return pairs.join(x, "sid").join(y, "leader").mapInArrow(_may_link(threshold), "sid long, leader long")

    def by_size(members: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members (sid, turn, leader) of clusters of up to CLUSTER sets, and of larger ones."""
        members = cut(members)
        sized = members.join(members.groupBy("leader").agg(F.count("*").alias("of")), "leader").select("sid", "turn", "leader", "of")
        return sized.filter(F.col("of") <= CLUSTER).drop("of"), sized.filter(F.col("of") > CLUSTER).drop("of")

    def near(members: DataFrame, all_pairs: bool) -> DataFrame:
        own = members.join(among(prints, "sid", members.select("sid")), "sid")
        return own.groupBy("leader").applyInPandas(_near_in_cluster(threshold, all_pairs), _NEAR)

    def found(pairs: DataFrame) -> DataFrame:
        return _compare(pairs, sets, threshold).filter("linked").select(F.col("sid").alias("a"), F.col("leader").alias("b"))

    keyed = cut(keyed)
    # Most keys are filed once: those go by their number alone, a third of the bytes of what tells sets apart.
    often = cut(keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1").select("key"))
    keyed = cut(among(keyed, "key", often))
    keyed = cut(_rarer(keyed, cut(_several(keyed, "key", by="sid")), threshold))
    shared = cut(_several(keyed, "key", by="sid"))
    groups = cut(keyed.join(shared, "key").select("key", "sid", "size", F.col("sid").alias("part")))
    # Linked sets share keys worth SHARED, so a set whose own shared keys are worth less has no link.
    worth = groups.groupBy("sid").agg(F.sum(_worth()).alias("worth")).filter(F.col("worth") >= SHARED)
    groups = cut(among(groups, "sid", worth.select("sid")))
    # Sets that stand in most large groups, such as the text that others were copied from, lead them.
    crowd = groups.filter(F.col("size") > SMALL).select("key", "sid").distinct()
    turn = crowd.groupBy("sid").agg((-F.count("*")).alias("turn"))
    middle, large = by_size(_led(crowd.join(turn, "sid"), "key"))
    itself, pair = F.col("sid").alias("part"), ("sid", "leader")
    clusters, close = [middle.select(*pair)], [cut(near(middle.select(*pair, itself), False))]
    pairs = cut(likely(cut(_pairs_of_small(groups, "key"))).union(close[0].select(*pair)).distinct())
    sets = sets_of(pairs.select("sid").union(pairs.select("leader")).union(large.select("sid")).distinct())
    links, more = [], [pairs]
    while not large.isEmpty():
        seen = cut(_against_leader(_compare(large.filter("sid <> leader"), sets, threshold, "turn"), threshold))
        links.append(seen.filter("linked").select(F.col("sid").alias("a"), F.col("leader").alias("b")))
        # Of a cluster with members that don't link with the leader: those that share an added shingle meet again.
        open_ = seen.join(seen.filter("not linked").select("leader").distinct(), "leader")
        added = open_.select(F.col("leader").alias("from"), "sid", "part", "turn", F.explode("added").alias("shingle"))
        shared = cut(_several(added, "from", "shingle", by="part"))
        groups = cut(among(added, "shingle", shared.select("shingle")).join(shared, ["from", "shingle"]))
        middle, large = by_size(_led(groups.filter(F.col("size") > SMALL).select("from", "shingle", "sid", "turn"), "from", "shingle"))
        clusters.append(middle.select(*pair))
        close.append(cut(near(middle.select(*pair, itself), False)))
        again = likely(cut(_pairs_of_small(groups, "from", "shingle").union(_few_additions(open_, threshold)).distinct()))
        more.append(cut(again.union(close[-1].select(*pair)).distinct()))
    pairs = cut(_all(more).distinct()) if len(more) > 1 else pairs
    roots = components(_all([*links, found(pairs.filter("sid <> leader"))]))
    # What the nearest pairs left apart: all pairs of different components of a cluster that may link.
    dense = cut(_all(close).filter("left").select(F.col("cluster").alias("leader")).distinct())
    if dense.isEmpty():
        return roots
    own = _all(clusters).distinct().join(dense, "leader").join(roots.withColumnRenamed("node", "sid"), "sid", "left")
    own = cut(own.select(*pair, F.coalesce("root", "sid").alias("part")))
    rest = cut(near(own.join(_several(own, "leader", by="part").select("leader"), "leader").select(*pair, "part"), True).select(*pair).distinct())
    return joined_components(roots, cut(found(rest))) if not rest.isEmpty() else roots


def _all(frames: list) -> DataFrame:
    return reduce(DataFrame.union, frames)


def _against_leader(seen: DataFrame, threshold: int) -> DataFrame:
    """What the algebra above needs of members: a, r, the first additions in hash order, a hash of what is missing, and
    their part: the leader if they link with it, else themselves."""
    enough = F.floor(F.lit(100 - threshold) * F.col("n") / 100).cast("int") + 1
    return seen.select("sid", "leader", "turn", "n", "m", "linked", F.when(F.col("linked"), F.col("leader")).otherwise(F.col("sid")).alias("part"),
                       (F.col("n") - F.col("both")).alias("a"), (F.col("m") - F.col("both")).alias("r"),
                       F.slice(F.array_except("shingles", "of_leader"), F.lit(1), enough).alias("added"),
                       F.xxhash64(F.array_except("of_leader", "shingles")).alias("gap"))


def _few_additions(open_: DataFrame, threshold: int) -> DataFrame:
    """Pairs of a cluster that may link without a common addition: a_x + a_y + |r_x - r_y| <= H.

    x, not linked with the leader, is over its bound by ``excess``; y must lack more than it adds by at least that
    much (``room``).  Both are filed by the power of two of the amount and meet there.  Without common additions
    members of a part that add as many shingles and lack the same ones are alike to x, so one of them stands for all."""
    t = threshold
    # |x ^ y| <= (100-t)(|x|+|y|)/(100+t); scaled by (100+t): everything in whole numbers.
    excess = (100 + t) * (F.col("a") + F.col("r")) - (100 - t) * (F.col("n") + F.col("m"))
    room = 2 * t * (F.col("r") - F.col("a"))
    step = lambda c: F.floor(F.log2(c.cast("double"))).cast("int")
    base = open_.select("leader", "sid", "part", "a", "r", "n", "gap", excess.alias("excess"), room.alias("room"), "linked")
    x = base.filter("not linked and excess > 0").withColumn("bin", step(F.col("excess")))
    alike = base.filter("room > 0").groupBy("leader", "part", "a", "r", "n", "gap", "room").agg(F.min("sid").alias("sid"))
    y = (alike.withColumn("bin", F.explode(F.sequence(F.lit(0), step(F.col("room")))))
         .select("leader", "bin", *[F.col(c).alias(c + "_y") for c in ("sid", "part", "a", "r", "n", "room")]))
    fits = (F.col("excess") <= F.col("room_y")) & (F.col("part") != F.col("part_y")) & (
        (100 + t) * (F.col("a") + F.col("a_y") + F.abs(F.col("r") - F.col("r_y"))) <= (100 - t) * (F.col("n") + F.col("n_y")))
    pair = x.join(y, ["leader", "bin"]).filter(fits)
    return pair.select(F.greatest("sid", "sid_y").alias("sid"), F.least("sid", "sid_y").alias("leader")).distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4,
                       threshold: int = 85) -> DataFrame:
    """One row per row of ``docs``: doc_id, rk (row key), n_shingles, component_id."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    base = base.withColumn("rk", row_key("doc_id", "text"))
    rows = cut(base.mapInArrow(_describe(k, threshold), "doc_id long, rk long, n_shingles long, sid long, print binary"))
    full = rows.filter("n_shingles > 0")
    prints = cut(full.groupBy("sid").agg(F.min("rk").alias("rk"), F.min("n_shingles").alias("n"), F.min("print").alias("print")))
    # of rows with equal sets one is filed, and the few others that pass the bitmap
    keyed = base.select("rk", "text").mapInArrow(_file(k, threshold, Among(prints, "rk")), "key long, sid long")

    def sets_of(sids: DataFrame) -> DataFrame:
        one = cut(prints.select("sid", "rk").join(sids, "sid", "left_semi").select("rk"))
        found = base.select("rk", "text").mapInArrow(_sets(k, Among(one, "rk")), "rk long, sid long, shingles array<long>")
        found = cut(found.drop("rk").withColumn("number", F.xxhash64(F.monotonically_increasing_id())))
        # of rows that repeat, one; the sets themselves aren't shuffled for that
        return among(found, "number", found.groupBy("sid").agg(F.min("number").alias("number")).select("number")).drop("number")

    root = similarity_links(keyed, prints.select("sid", "n", "print"), sets_of, threshold)
    least = full.groupBy("sid").agg(F.min("doc_id").alias("least"))
    least = least.join(root.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    whole = least.groupBy("root").agg(F.min("least").alias("component_id"))
    by_set = least.join(whole, "root").select("sid", "component_id")
    return (full.join(by_set, "sid", "left").select("doc_id", "rk", "n_shingles", "component_id")
            .union(rows.filter("n_shingles = 0").select("doc_id", "rk", "n_shingles", F.col("doc_id").alias("component_id"))))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the members of a component other than the one with its smallest id.  Rows that repeat id
    and text stay together; a component without any id keeps all its rows."""
    found = jaccard_components(docs, id_col, text_col, **options)
    gone = found.filter("doc_id is null and component_id is not null or doc_id <> component_id").select(F.col("rk").alias("__gone")).distinct()
    key = F.xxhash64(F.col(id_col).cast("long"), text_or_empty(text_col))
    return docs.join(gone, key == F.col("__gone"), "left_anti")
