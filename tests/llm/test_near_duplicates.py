"""Operators on repeated text against brute force: suffix dedup, line dedup, n-gram join, decontamination."""

import itertools
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lienlake.llm import decontamination, line_dedup, ngram_join, suffix_dedup
from lienlake.llm.common import Among, among, cut
from lienlake.llm.components import components, joined_components
from lienlake.llm.tokens import Hasher

from .conftest import split_words


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# ---- shingles, keys --------------------------------------------------------

def shingles(text, k=4):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1)))


def linked(x, y, t=85):
    both = len(x & y)
    return bool(x) and bool(y) and 100 * both >= t * (len(x) + len(y) - both)


def brute_components(rows, k=4, t=85):
    """component of each row, by all pairs of different sets."""
    sets = [shingles(text, k) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        if 100 * min(len(sets[i]), len(sets[j])) >= t * max(len(sets[i]), len(sets[j])) and linked(sets[i], sets[j], t):
            parent[root(j)] = root(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(((doc, len(sets[i]), least.get(root(i))) for i, (doc, _) in enumerate(rows)), key=str)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ngram_join_matches_brute_force(mixed):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(mixed).collect()), key=str)
    assert got == brute_components(rows_of(mixed))


@pytest.mark.parametrize("small, cluster, few, k, threshold", [(2, 4000, 0, 5, 80), (2, 4000, 100, 4, 85), (1000, 4000, 1, 4, 85), (2, 30, 1, 4, 85)])
def test_ngram_join_through_leaders(spark, monkeypatch, small, cluster, few, k, threshold):
    """A large group of near copies: by pairs, by fingerprints in clusters at once or nearest first, and through leaders."""
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "CLUSTER", cluster)
    monkeypatch.setattr(ngram_join, "FEW", few)
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in rng.integers(0, 5000, 90)]
    rows = []
    for i in range(60):
        w = list(base)
        for p in rng.integers(0, 90, rng.integers(0, 7)):
            w[p] = f"n{rng.integers(0, 12)}"
        if i % 3 == 0:
            w = w[: 90 - int(rng.integers(0, 14))]
        rows.append((i, " ".join(w)))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"])
                  for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), k=k, threshold=threshold).collect()), key=str)
    assert got == brute_components(rows, k, threshold)
    assert 1 < len({c for _, _, c in got}) < 60


@pytest.mark.parametrize("threshold", [85, 80])
@pytest.mark.parametrize("size", [1, 6, 7, 12, 13, 25, 40, 90, 300])
def test_linked_sets_share_enough_keys(size, threshold):
    """Any two sets of a linked pair's sizes share a deep band's key or SHARED plain ones in the larger set's band."""
    rng = np.random.default_rng(size)
    for _ in range(60):
        x = rng.integers(0, 2**63, size, np.uint64)
        y = x.copy()
        change = int(rng.integers(0, size * (100 - threshold) // 100 + 1))
        y[:change] = rng.integers(0, 2**63, change, np.uint64)
        y = np.append(y, rng.integers(0, 2**63, int(rng.integers(0, size * (100 - threshold) // 120 + 1)), np.uint64))
        x, y = np.unique(x), np.unique(y)
        if len(x) > len(y):
            x, y = y, x
        if not linked(set(x.tolist()), set(y.tolist()), threshold) or set(x.tolist()) == set(y.tolist()):
            continue
        b = ngram_join.band_of(len(y))
        plan = ngram_join.allocate(b, threshold)
        common = np.intersect1d(ngram_join.keys_of(x, b, plan), ngram_join.keys_of(y, b, plan))
        assert len(common) >= (1 if plan[1] else ngram_join.SHARED)
        assert b - ngram_join.band_of(len(x)) in (0, 1)


def pairs_of_few_shingles(rng, k, n):
    """Pairs of texts of 7 to 26 shingles that share no words with other pairs: one word is replaced or some appended."""
    rows = []
    for i in range(n):
        w = [f"p{i}w{x}" for x in range(int(rng.integers(7, 27)) + k - 1)]
        v = list(w)
        if i % 2:
            v[[0, -1][i % 4 // 2]] = f"p{i}other"
        else:
            v = v + [f"p{i}more{x}" for x in range(int(rng.integers(1, 5)))]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
    return rows


def test_ngram_join_links_short_texts(spark):
    """Bands with deep segments promise one common key, so one is enough for a pair to be compared."""
    rows = pairs_of_few_shingles(np.random.default_rng(8), 4, 400)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"])
                  for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    want = brute_components(rows)
    assert got == want and sum(doc != least for doc, _, least in want) > 100


@pytest.mark.parametrize("b", range(14))
def test_a_key_tells_whether_it_is_enough(b):
    plan = ngram_join.allocate(b, 85)
    keys = ngram_join.keys_of(np.arange(ngram_join.band_start(b), dtype=np.uint64), b, plan)
    assert set((keys & np.uint64(1)).tolist()) == {int(plan[1] > 0)}


@pytest.mark.parametrize("threshold", [85, 80])
@pytest.mark.parametrize("size", [1, 2, 3, 8, 9, 17, 100, 1000])
def test_fingerprints_are_a_lower_bound(size, threshold):
    """Fingerprints, folded onto equal lengths, differ in no more cells than the sets in shingles."""
    rng = np.random.default_rng(size)
    for _ in range(40):
        x = rng.integers(0, 2**63, size, np.uint64)
        y = np.append(x[int(rng.integers(0, size + 1)):], rng.integers(0, 2**63, int(rng.integers(0, 2 * size + 2)), np.uint64))
        if not len(y):
            continue
        a, b = (np.frombuffer(ngram_join.fingerprint(z, threshold), np.uint8) for z in (x, y))
        while len(a) != len(b):
            a, b = (ngram_join._folded(a), b) if len(a) > len(b) else (a, ngram_join._folded(b))
        assert ngram_join._cells_apart(a, b) <= len(np.setxor1d(x, y))


def test_bitmap_lets_all_wanted_pass(spark):
    values = spark.range(20_000).select(F.xxhash64("id").alias("h"))
    wanted = values.limit(3000).cache()
    passed = {r["h"] for r in among(values, "h", wanted).collect()}
    assert {r["h"] for r in wanted.collect()} <= passed and len(passed) < 3400
    assert among(values, "h", wanted.limit(0)).count() == 0


def test_further_links_join_components(spark):
    roots = components(spark.createDataFrame([(1, 2), (3, 4), (5, 6)], "a long, b long"))
    got = dict(map(tuple, joined_components(roots, spark.createDataFrame([(2, 4), (8, 9), (6, 9), (1, 2)], "a long, b long")).collect()))
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 5, 8: 5, 9: 5}


def test_ngram_join_of_nothing_and_stage(nothing, edges):
    assert ngram_join.jaccard_components(nothing).count() == 0
    kept = ngram_join.keep_one_of_each(edges)
    assert kept.columns == edges.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert 2 not in ids and 1 in ids and 7 in ids       # 2 and the one without id repeat 1
    assert ids.count(9) == 2 and ids.count(None) == 1


# ---- lines -------------------------------------------------------------------

def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def units_of(words, fuzzy_words=8):
    return words if len(words) >= fuzzy_words else b" ".join(words).decode()


def brute_lines(rows, fuzzy_words=8, fuzzy_chars=8, edits=1):
    lines = [(i, j, tuple(x.encode().split())) for i, t in sorted(rows) for j, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    first, by_key, out = {}, defaultdict(list), {}
    for i, j, w in lines:
        found = [(*first[w], 0)] if w in first else []
        u = units_of(w, fuzzy_words)
        fuzzy = edits and (not isinstance(u, str) or len(u) >= fuzzy_chars)
        keys = {u} | {u[:p] + u[p + 1:] for p in range(len(u))} if fuzzy else ()
        for k in keys:
            found += [(a, b, 1) for a, b, x in by_key[k] if x != u and type(x) is type(u) and near(x, u)]
        if found:
            out[i, j] = min(found)
        if w not in first:
            first[w] = (i, j)
            for k in keys:
                by_key[k].append((i, j, u))
    return out


def test_line_dedup_matches_brute_force(documents):
    got = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"], r["edits"]) for r in line_dedup.duplicate_lines(documents).collect()}
    assert got == brute_lines(rows_of(documents))


def test_line_dedup_finds_each_kind_of_edit(spark):
    line = "one two three four five six seven eight nine"
    variants = [line, line.replace("five ", ""), line.replace("five", "5"), "zero " + line, line + " ten", line.replace("nine", "9 10 11"),
                "one one two three four five six seven eight", "short line here", "short  line here", "two words"]
    rows = [(i, v) for i, v in enumerate(variants)] + [(20, line), (None, line)]
    got = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["edits"]) for r in
           line_dedup.duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 0): (0, 1), (2, 0): (0, 1), (3, 0): (0, 1), (4, 0): (0, 1), (8, 0): (7, 0), (20, 0): (0, 0), (None, 0): (0, 0)}


@pytest.mark.parametrize("edits", [0, 1])
def test_short_lines_take_part(spark, edits):
    """Lines under 8 words by characters, under 8 characters if they are equal."""
    texts = ["subscribe to our newsletter today please now", "subscribe to our newsletter today please Now", "subscribe to our newsletter today please no",
             "subscribe to our newsletters todaX please now", "Menu", "Menu", "menu", "Home page", "Home page", "Home pages", "Home  \tpagé", "Home page x y",
             "a b c d e f g h", "a b c d e f g", "déjà vue", "déja vue", " ", "-", "-"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(99, "\n".join(texts))]
    found = line_dedup.duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string"), edits=edits).collect()
    got = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"], r["edits"]) for r in found}
    assert got == brute_lines(rows, edits=edits)
    near_ones = {(1, 0), (2, 0), (9, 0), (10, 0), (15, 0)}
    assert (near_ones <= set(got)) if edits else not near_ones & set(got)
    assert {(5, 0), (8, 0), (18, 0)} <= set(got) and (6, 0) not in got and (13, 0) not in got


def test_dropping_lines(edges, nothing):
    out = line_dedup.drop_duplicate_lines(edges)
    assert out.columns == edges.columns
    rows = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert (9, "a\n\n\nb c d") in rows and (4, "") in rows and (3, None) in rows
    assert [i for i, _ in rows].count(2) == 0 and line_dedup.drop_duplicate_lines(nothing).count() == 0


def shuffled(df):
    """What each exchange of the plan of ``df`` is given."""
    parts = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted").split("\n(")
    return [x for p in parts if re.match(r"\d+\) (Broadcast)?Exchange", p) for x in re.findall(r"Input.*", p)]


def test_line_dedup_shuffles_no_text(spark, monkeypatch, edges):
    """Lines are picked where the texts are read, however many are wanted: the texts were shuffled to meet the numbers."""
    seen = []

    def spy(df):
        seen.extend(shuffled(df))
        return cut(df)
    monkeypatch.setattr(line_dedup, "cut", spy)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen.extend(shuffled(line_dedup.duplicate_lines(edges)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert any("rk#" in x and "line_no#" in x for x in seen) and not any("text#" in x for x in seen)


def test_lines_are_picked_from_rows_that_share_id_and_text(spark):
    """Each wanted line comes once, from texts of several chunks too."""
    line = "one two three four five six seven eight nine"
    long = "\n".join([line, *(f"w{i} is on no other line at all but here" * 3 for i in range(20_000)), line.replace("five", "5")])
    rows = [(1, long), (1, long), (2, "x\n" + line + " ten"), (2, "x\n" + line + " ten"), (None, line.replace("one", "1")), (None, line.replace("one", "1"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["line_no"], r["keep_doc_id"], r["keep_line_no"], r["edits"]) for r in line_dedup.duplicate_lines(docs).collect()), key=str)
    assert got == [(1, 20_001, 1, 0, 1), (2, 1, 1, 0, 1), (None, 0, 1, 0, 1)]


# ---- passages ------------------------------------------------------------------

def brute_passages(rows, width=50):
    docs = {(i, t): (t or "").encode().split() for i, t in rows}
    seen = defaultdict(set)
    for k, w in docs.items():
        for p in range(len(w) - width + 1):
            seen[tuple(w[p:p + width])].add(k)
    out = set()
    for k, w in docs.items():
        spans = []
        for p in range(len(w) - width + 1):
            if len(seen[tuple(w[p:p + width])]) > 1:
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + width
                else:
                    spans.append([p, p + width])
        if spans:
            out.add((k[0], ",".join(f"{a}:{b}" for a, b in spans)))
    return out


def test_passages_match_brute_force(mixed):
    got = suffix_dedup.passages_by_document(mixed).collect()
    assert {(r["doc_id"], r["spans"]) for r in got} == brute_passages(rows_of(mixed))
    assert all(r["n_words"] >= 50 * r["n_spans"] and 0 <= r["follows_words"] <= r["n_words"] for r in got)


def test_passages_of_edge_rows(edges, nothing):
    got = {(r["doc_id"], r["spans"]) for r in suffix_dedup.passages_by_document(edges).collect()}
    assert got == brute_passages(rows_of(edges))
    assert suffix_dedup.passages_by_document(nothing).count() == 0


def test_minimisers_cover_every_window():
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 50, 500).astype(np.uint64)
    kept = set(suffix_dedup.minimisers(grams, 17).tolist())
    assert all(kept & set(range(i, i + 17)) for i in range(500 - 16))


# ---- benchmark -----------------------------------------------------------------

def brute_leaks(rows, items, window=14, wrong=2, least=8):
    out = set()
    for (doc, text), (item, asked) in itertools.product(rows, items):
        w, a = [[x.lower() for x in split_words(t)] for t in (text, asked)]
        if len(a) < least:
            continue
        for d in range(-len(a) + 1, len(w)):
            same = [0 <= d + j < len(w) and w[d + j] == a[j] for j in range(len(a))]
            if len(a) < window:
                hit = all(same)
            else:
                hit = any(sum(same[s:s + window]) >= window - wrong for s in range(len(a) - window + 1))
            if hit:
                out.add((doc, item))
                break
    return out


def test_masks_answer_for_every_substitution():
    for wrong in itertools.combinations(range(decontamination.WINDOW), decontamination.SUBSTITUTIONS):
        assert any(not {m + s for m in mask} & set(wrong) for mask in decontamination.MASKS
                   for s in range(decontamination.WINDOW - mask[-1]))


@pytest.fixture(scope="module")
def leaks(spark):
    rng = np.random.default_rng(2)
    word = lambda: f"w{rng.integers(0, 30)}"
    items = [(i, " ".join(word() for _ in range(int(n)))) for i, n in enumerate([3, 8, 10, 13, 14, 15, 20, 40])] + [(90, None), (91, "")]
    items += [(None, " ".join(f"null{i}" for i in range(16))), (5, " ".join(f"other{i}" for i in range(15)))]
    rows = []
    for i in range(60):
        text = [word() for _ in range(30)]
        part = split_words(items[int(rng.integers(0, 8))][1])
        for _ in range(int(rng.integers(0, 4))):
            part[int(rng.integers(0, len(part)))] = "OTHER"
        at = int(rng.integers(0, 30))
        rows.append((i, " ".join(text[:at] + part[int(rng.integers(0, 3)):] + text[at:]).upper()))
    rows += [(60, None), (61, ""), (None, items[6][1]), (3, items[7][1]), (62, "x " + items[-2][1]), (63, items[-1][1] + " y")]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows, spark.createDataFrame(items, "item_id long, text string"), items


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_decontamination_matches_brute_force(leaks, broadcast_rows):
    docs, rows, asked, items = leaks
    got = decontamination.contaminated(docs, asked, broadcast_rows=broadcast_rows).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute_leaks(rows, items)
    assert {(62, None), (63, 5)} <= {(r["doc_id"], r["item_id"]) for r in got}


def test_decontamination_stage(leaks, nothing):
    docs, rows, asked, items = leaks
    bad = {i for i, _ in brute_leaks(rows, items) if i != 3}
    kept = decontamination.drop_contaminated(docs, asked).collect()
    assert {r["doc_id"] for r in kept if r["doc_id"] != 3} == {i for i, _ in rows if i != 3} - bad
    assert decontamination.drop_contaminated(nothing, asked).count() == 0
    assert decontamination.drop_contaminated(docs, asked.limit(0)).count() == len(rows)


# ---- hashing ---------------------------------------------------------------------

def test_word_hashes_do_not_depend_on_place():
    hasher = Hasher()
    text = "Some words, some Words é and some words,\x0bagain"
    h, at, end = hasher.tokens(text.encode())
    found = [text.encode()[a:b] for a, b in zip(at, end)]
    assert [x.decode() for x in found] == split_words(text)
    by_word = defaultdict(set)
    for word, x in zip(found, h.tolist()):
        by_word[word.lower()].add(x)
    assert all(len(v) == 1 for v in by_word.values()) and len({min(v) for v in by_word.values()}) == len(by_word)
    run = hasher.running(h)
    first = np.arange(len(h) - 1)
    pair = hasher.stretch(run, first, first + 2)
    assert pair[0] == pair[6] and len(set(pair.tolist())) == len(pair) - 1


def test_a_deletion_key_is_filed_with_a_number_only(spark):
    import pyarrow as pa

    lines = pa.RecordBatch.from_pydict({"no": [7, 9], "line": ["a b c d e f g h", "short line"]})
    filed = pa.Table.from_batches(line_dedup._deletions(8)([lines]))
    assert filed.schema.names == ["key", "place", "no"] and filed.nbytes <= 20 * len(filed)
    assert sorted(filed["no"].to_pylist()) == [7] * 9 + [9] * 11


def test_line_dedup_keeps_the_earliest_by_place(spark):
    """Numbers grow with the place: null ids come last, ids are compared as numbers."""
    line = "one two three four five six seven eight"
    docs = spark.createDataFrame([(None, line + " x"), (10, line + " y"), (9, "blank\n" + line + " z"), (-3, "other words")], "doc_id long, text string")
    found = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"], r["edits"]) for r in line_dedup.duplicate_lines(docs).collect()}
    assert found == {(10, 0): (9, 1, 1), (None, 0): (9, 1, 1)}


def test_dropped_lines_leave_the_rest_as_it_was(spark):
    line = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, line, 39), (2, f"\n{line}\n\nlast\n", 0), (2, f"\n{line}\n\nlast\n", 0), (3, line + " nine", 0), (4, None, 0)],
                                 "doc_id long, text string, n_chars int")
    out = sorted((tuple(r) for r in line_dedup.drop_duplicate_lines(docs).collect()))
    assert out == [(1, line, 39), (2, "\n\nlast\n", 7), (2, "\n\nlast\n", 7), (4, None, 0)]


@pytest.mark.parametrize("n", [3000, 5000, 40_000])
def test_bitmap_is_filled_to_a_part_only(spark, n):
    bits = Among(spark.range(n).select(F.xxhash64("id").alias("h")), "h").bits
    assert Among.SPARSE * np.bitwise_count(bits).sum() <= 8 * len(bits)


def test_equal_sets_are_filed_once(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, text if i else text + " x") for i in range(12)], "rk long, text string").repartition(12)
    filing = Among(docs.filter("rk in (0, 5)"), "rk")
    keyed = docs.mapInArrow(ngram_join._file(4, 85, filing), "key long, sid long")
    assert keyed.groupBy("sid", "key").count().filter("count > 1").isEmpty() and keyed.select("sid").distinct().count() == 2


def test_strangers_with_common_passages_leave_no_large_groups(spark):
    """Texts of their own that share a fifth of their shingles, one or two of a segment: those keys are left out, and a
    near copy of each is still found."""
    rng = np.random.default_rng(5)
    common = rng.integers(0, 2**63, 70, np.uint64)
    b, rows, pairs = ngram_join.band_of(330), [], []
    plan = ngram_join.allocate(b, 80)
    for i in range(60):
        x = np.append(rng.integers(0, 2**63, 270, np.uint64), rng.choice(common, 60, replace=False))
        y = np.append(rng.integers(0, 2**63, 33, np.uint64), x[33:])
        pairs.append((2 * i, 2 * i + 1))
        for sid, z in zip(pairs[-1], (x, y)):
            rows += [(int(key), sid) for key in ngram_join.keys_of(np.unique(z), b, plan).view(np.int64)]
    keyed = spark.createDataFrame(rows, "key long, sid long")
    sized = ngram_join._several(keyed, "key", by="sid")
    large = sized.filter("size > 4").count()
    assert large > 20
    kept = ngram_join._rarer(keyed, sized, 80)
    assert 10 * ngram_join._several(kept, "key", by="sid").filter("size > 4").count() < large
    of = {}
    for r in kept.collect():
        of.setdefault(r["sid"], set()).add(r["key"])
    assert all(len(of[x] & of[y]) >= ngram_join.SHARED for x, y in pairs)


@pytest.mark.parametrize("threshold", [85, 80])
def test_linked_sets_share_enough_keys_that_are_not_left_out(threshold):
    """Whatever order all sets leave out their first keys in, SHARED of those that linked sets share remain."""
    rng = np.random.default_rng(threshold)
    for size in (90, 300, 1500, 3000):
        b = ngram_join.band_of(size)
        plan, gone = ngram_join.allocate(b, threshold), ngram_join.left_out(b, threshold)
        assert plan[1] == 0 and gone > 0
        for i in range(40):
            x = rng.integers(0, 2**63, size, np.uint64)
            most = ngram_join.most_different(size, size, threshold) // 2
            y = np.append(rng.integers(0, 2**63, most, np.uint64), x[most:])
            k, m = (np.sort(ngram_join.keys_of(np.unique(z), b, plan) >> np.uint64(i % 3)) for z in (x, y))
            if i % 2:  # what they share goes first
                both = np.intersect1d(k, m)
                k, m = (np.append(both, np.setdiff1d(z, both)) for z in (k, m))
            assert len(np.intersect1d(k[gone:], m[gone:])) >= ngram_join.SHARED
