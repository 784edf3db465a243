"""Packing, conversation repair and periodic runs against brute force."""

import bisect
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lienlake.llm import conversation_repair as cr
from lienlake.llm import packing, periodic_runs, queries

from .conftest import split_words


# ---- packing ---------------------------------------------------------------

def naive_rooms(lengths, capacity):
    """Rooms that best-fit decreasing leaves, piece by piece."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, n)
        bisect.insort(rooms, (rooms.pop(i) if i < len(rooms) else capacity) - n)
    return rooms


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=120))))
def test_plan_is_best_fit_decreasing(given_):
    capacity, lengths = given_
    plan = packing.best_fit(Counter(lengths), capacity)
    filled, starts = defaultdict(list), [p.number for p in plan]
    for number, n in enumerate(sorted(lengths, reverse=True)):
        p = plan[bisect.bisect_right(starts, number) - 1]
        turn = number - p.number
        assert p.length == n
        filled[p.sequence + turn // p.each].append((p.offset + turn % p.each * n, n))
    for own in filled.values():
        assert [at for at, _ in sorted(own)] == [0, *itertools.accumulate(n for _, n in sorted(own))][:-1]
    assert sorted(filled) == list(range(len(filled)))
    assert sorted(capacity - sum(n for _, n in own) for own in filled.values()) == naive_rooms(lengths, capacity)


def test_plan_does_not_grow_with_the_corpus():
    rng = random.Random(3)
    few = Counter(min(2048, 1 + int(rng.expovariate(1 / 500))) for _ in range(20_000))
    plan = packing.best_fit(few, 2048)
    many = packing.best_fit({k: 10**6 * v for k, v in few.items()}, 2048)
    assert len(plan) < 40_000 and len(many) < 40_000


def brute_pieces(rows, capacity=2048):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    out = []
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for p, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at:at + capacity]
            out.append((doc, p, at, len(own), zlib.crc32(own.tobytes())))
    return sorted(out, key=str)


def check_packed(got, rows, capacity=2048):
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == brute_pieces(rows, capacity)
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by.values():
        assert [at for at, _ in sorted(own)] == [0, *itertools.accumulate(n for _, n in sorted(own))][:-1]
    assert sorted(capacity - sum(n for _, n in own) for own in by.values()) == naive_rooms([r["length"] for r in got], capacity)


def test_packing_query(spark, tables, documents):
    got = queries.op11_best_fit_packing(spark, tables)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    check_packed(got.collect(), rows)
    assert sorted(map(str, got.collect())) == sorted(map(str, queries.op11_best_fit_packing(spark, tables).collect()))


def test_packing_of_edge_rows(edges, nothing):
    crc = lambda df: df.withColumn("ids_crc32", F.crc32("ids"))
    odd = edges.sparkSession.createDataFrame([(70, "ΣΑΣ ÉTÉ don't  I'M <|endoftext|> x.y z w"), (71, "İi̇ \x1c\x1d a\x0bb")], "doc_id long, text string")
    docs = edges.select("doc_id", "text").union(odd)
    found = packing.pack(crc(packing.pieces(docs, queries.tokenizer_file(), capacity=64)), 64)
    check_packed(found.collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], 64)
    whole = packing.sequences(found)
    own = {r["sequence_id"]: r["ids"] for r in whole.collect()}
    assert all(bytes(own[r["sequence_id"]][4 * r["offset"]:4 * (r["offset"] + r["length"])]) == bytes(r["ids"]) for r in found.collect())
    assert packing.pack(packing.pieces(nothing, queries.tokenizer_file())).count() == 0


# ---- conversations ---------------------------------------------------------

def cheapest(rows):
    """(cost, audit, repaired rows) by the suffix dynamic programme over single rows; rows (role, text, flaw)."""
    nexts, fits = {"": "u", "s": "u", "u": "a", "a": "u"}, {"": "su", "s": "u", "u": "a", "a": "u"}
    n, least = len(rows), {}
    least[n] = {"": (0, ""), "a": (0, ""), "u": (5, "I"), "s": (10, "II")}
    for i in range(n - 1, -1, -1):
        role, _, flaw = rows[i]
        more, now = 5 if flaw == "t" else 0, {}
        for state in nexts:
            c, a = least[i + 1][state]
            options = [(c + 2, "D" + a)]
            if flaw not in "bd":
                if role[:1] and role[0] in fits[state]:
                    c, a = least[i + 1][role[0]]
                    options.append((c + more, "K" + a))
                c, a = least[i + 1][nexts[state]]
                options.append((c + more + 1, "R" + a))
            now[state] = min(options)
        for _ in range(3):
            for state in nexts:
                c, a = now[nexts[state]]
                now[state] = min(now[state], (c + 5, "I" + a))
        least[i] = now
    cost, audit = least[0][""]
    out, state, at = [], "", 0
    for letter in audit:
        if letter != "D":
            state = rows[at][0][0] if letter == "K" else nexts[state]
            out.append((rows[at][0] if letter == "K" else {"u": "user", "a": "assistant"}[state], "" if letter == "I" else rows[at][1]))
        at += letter != "I"
    return cost, audit, out


def brute_repair(table):
    """The digest of every conversation; table rows (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in table:
        one = lambda x: " " if x is None else str(x)
        role, text, kind = one(role), one(text), zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        own[conv] += []
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, rows in own.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, flawed = set(), []
        for _, role, text in rows:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            flawed.append((role, text, "b" if not bare else "d" if (role, text) in seen else "k" if bare[-1] in ".!?" else "t"))
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        initials = [r[:1] for r, _, _ in flawed]
        cost, audit, left = cheapest(flawed)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(sum(f == k for _, _, f in flawed) for k in "bdt"),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()))
    return sorted(out, key=str)


DIGEST = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired(rows, **options):
    return sorted((tuple(r) for r in cr.digest(rows, cr.repair(cr.damaged(rows), **options)).select(*DIGEST).collect()), key=str)


def test_run_length_choices_match_single_rows():
    rng = random.Random(11)
    flaw = {"x": "b"}
    for _ in range(400):
        alphabet = rng.sample("xsuaoSUAO", rng.randrange(1, 5))
        symbols = "".join(rng.choice(alphabet) * rng.choice([1, 1, 2, 3, 7, 20]) for _ in range(rng.randrange(0, 6)))
        rows = [(s.lower() + "-role", "x", flaw.get(s, "t" if s.isupper() else "k")) for s in symbols]
        cost, audit, left = cheapest(rows)
        runs = cr.runs_of(symbols)
        got, state = cr.choices(runs, 0, cr.LAST)
        got += cr.closing(state)
        assert (cr.costs_before(runs, cr.LAST)[0], got) == (cost, audit)
        assert list(zip(*cr.edited(got, 0, [r for r, _, _ in rows], [t for _, t, _ in rows]))) == left


def test_a_long_run_is_a_few_products():
    audit, state = cr.unroll("u", 1_000_000, 0, cr.LAST)
    assert len(audit) == 1_000_000 and cr.before("u", 1_000_000, cr.LAST)[0] == 500_000 and (audit[:4], state) == ("KRKR", 3)


def test_conversation_query(spark, tables):
    rows = spark.read.parquet(f"{tables}/conversations.parquet")
    got = queries.op12_conversation_repair(spark, tables)
    assert got.columns[:9] == DIGEST
    want = brute_repair([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])
    assert sorted((tuple(r) for r in got.select(*DIGEST).collect()), key=str) == want


def odd_conversations(seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "What?", "cut of", "", " ", "\t\n", None, "Same.", "a\nb.", "é. \x0b"]
    roles = ["user"] * 4 + ["assistant"] * 4 + ["system", "tool", "", None, "User", "sys"]
    out = []
    for conv in [*range(60), None, -5]:
        turns = [None, None, *range(rng.randrange(0, 12))] if rng.random() < 0.3 else list(range(rng.randrange(1, 14)))
        out += [(conv, t if t is None or rng.random() < 0.9 else t - 1, rng.choice(roles), rng.choice([*texts, f"t{rng.random()}."])) for t in turns]
    out += [(77, t, "user" if t % 3 else "assistant", f"{t % 41}." if t % 5 else f"tail {t}") for t in range(700)]
    out += [(78, None, None, None)] * 3
    return out


@pytest.mark.parametrize("part", [1, 7, 1000])
def test_conversations_with_odd_rows(spark, part):
    table = odd_conversations(part)
    rows = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").repartition(5)
    assert repaired(rows, part=part) == brute_repair(table)


def test_conversations_with_clashing_columns_and_none(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")], "conv_id long, turn long, role string, text string")
    clash = rows.selectExpr("*", "1 as part", "2 as kind", "3 as copy", "4 as audit")
    assert repaired(clash) == repaired(rows)
    assert repaired(rows.limit(0)) == []


# ---- periodic runs ---------------------------------------------------------

def brute_runs(words, shortest=12):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(shortest, 2 * q):
                found.setdefault((start, length), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_planted(doc_id, words):
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def brute_periodic(doc_id, words):
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def periodic_texts(seed, many):
    rng, out = random.Random(seed), []
    for _ in range(many):
        n, k = rng.choice([0, 1, 11, 12, 13, 40, 120, 250]), rng.choice([1, 2, 3, 5, 40])
        w = [f"w{rng.randrange(k)}" for _ in range(n)]
        how = rng.random()
        if how < 0.4 and n > 3:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randrange(2, 9)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        elif how < 0.6:
            x, y = ["a"], ["a", "b"]
            while len(y) < n:
                x, y = y, y + x
            w = y[:n]
        out.append(w)
    return out


def test_runs_match_brute_force():
    texts = periodic_texts(4, 250)
    for lo in range(0, len(texts), 9):
        some = texts[lo:lo + 9]
        got = periodic_runs.runs_of([[w.encode() for w in t] for t in some])
        assert [[tuple(map(int, r)) for r in g] for g in got] == [brute_runs(t) for t in some]


def test_grammar_extensions_match_direct_comparison():
    rng = np.random.default_rng(6)
    for k in (1, 2, 4, 50):
        seq = np.concatenate([[-1], rng.integers(0, k, 300), [-2], np.tile(rng.integers(0, k, 17), 12), [-3]])
        grammar = periodic_runs.Grammar(seq)
        x, y = rng.integers(1, len(seq) - 1, 400), rng.integers(1, len(seq) - 1, 400)
        x, y = x[x != y], y[x != y]
        for way in (1, -1):
            def direct(a, b, way=way):
                n = 0
                while 0 <= a < len(seq) and 0 <= b < len(seq) and seq[a] == seq[b]:
                    a, b, n = a + way, b + way, n + 1
                return n
            assert grammar.extension(x, y, way).tolist() == [direct(a, b) for a, b in zip(x, y)]


def test_long_and_very_repetitive_texts():
    words = [b"w%d" % (i * 7919 % 5003) for i in range(70_000)]
    one, two, period = periodic_runs.runs_of([[b"a"] * 200_000, [b"a", b"b"] * 50_000, words[:5003] * 15])
    assert one.tolist() == [[0, 200_000, 1]] and two.tolist() == [[0, 100_000, 2]] and period.tolist() == [[0, 75_045, 5003]]


def test_periodic_query(spark, tables, documents):
    got = queries.op13_periodic_runs(spark, tables)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = [(r["doc_id"], split_words(r["text"])) for r in documents.select("doc_id", "text").collect()]
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows) > 5
    want = [brute_periodic(d, brute_planted(d, w)) for d, w in rows if len(w) < 4000]
    long = {d for d, w in rows if len(w) >= 4000}
    assert sorted((tuple(r) for r in got.collect() if r["doc_id"] not in long), key=str) == sorted(want, key=str)


def test_periodic_of_edge_rows(spark, edges, nothing):
    texts = [(i, " \t\n".join(w) if i % 2 else "\x0b".join(w)) for i, w in enumerate(periodic_texts(8, 60), 1000)]
    docs = edges.select("doc_id", "text").filter("text is null or length(text) < 50000").union(spark.createDataFrame(texts, "doc_id long, text string"))
    planted = docs.withColumn("text", periodic_runs.with_planted_runs())
    rows = [(r["doc_id"], split_words(r["text"])) for r in docs.collect()]
    got = periodic_runs.periodic_runs(planted).collect()
    want = []
    for d, w in rows:
        w = brute_planted(d, w)
        runs = brute_runs(w)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want.append((d, runs, " ".join(x for i, x in enumerate(w) if i not in gone)))
    assert sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=str) == sorted(want, key=str)
    assert periodic_runs.periodic_runs(nothing).count() == 0
