"""Weighted fair mixing against a plain sequential queue."""

import hashlib
from collections import defaultdict

import pytest

from lienlake.llm import mixing

from .conftest import split_words


def fair_targets(sizes, repeats=3):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, held, total = {}, set(), sum(sizes.values())
    while True:
        left = total - sum(repeats * sizes[s] for s in held)
        free = [s for s in names if s not in held]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > repeats * sizes[s] + 1e-9}
        if not over:
            return share | {s: repeats * sizes[s] for s in held}
        held |= over


def queue(rows, target, sizes, repeats=3, seed=17):
    """Words taken of each document: sends in the order of their finish times until the budget is used up."""
    sends = []
    by = defaultdict(list)
    for doc, n, source in rows:
        by[source].append((hashlib.md5(f"{doc}:{seed}".encode()).hexdigest(), doc, n))
    for s, docs in by.items():
        sent = 0
        for turn in range(repeats):
            for place, doc, n in sorted(docs):
                sent += n
                if n and target[s] > 0 and sent / target[s] <= 2:
                    sends.append((sent / target[s], s is None, s or "", place, doc, n))
    taken, used = defaultdict(int), 0
    for *_, doc, n in sorted(sends):
        used += n
        if used > sum(sizes.values()):
            break
        taken[doc] += n
    return taken


@pytest.mark.parametrize("bucket", [50_000, 20])
def test_mix_matches_a_sequential_queue(documents, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET", bucket)
    rows = [(r["doc_id"], len(split_words(r["text"])), r["source"]) for r in documents.collect()]
    sizes = defaultdict(int)
    for _, n, s in rows:
        sizes[s] += n
    target = fair_targets(sizes)
    got = {r["doc_id"]: r for r in mixing.mix(documents).collect()}
    assert len(got) == len(rows)
    for doc, n, s in rows:
        r = got[doc]
        assert (r["size"], r["source_size"]) == (n, sizes[s]) and r["target"] == pytest.approx(target[s])
    assert {d: r["taken"] for d, r in got.items() if r["taken"]} == dict(queue(rows, target, sizes))
    assert all(r["taken"] <= 3 * r["size"] for r in got.values())


def test_targets_are_held_at_three_times_a_source(spark):
    sizes = {"a": 1000, "b": 10, "c": 1, None: 5, "d": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    want = fair_targets(sizes)
    assert got == {s: pytest.approx(t) for s, t in want.items()} and sum(got.values()) == pytest.approx(1016)
    assert all(got[s] <= 3 * sizes[s] for s in sizes)


def test_mix_of_edge_rows(edges, nothing):
    got = mixing.mix(edges).collect()
    assert len(got) == edges.count() and mixing.mix(nothing).count() == 0
    assert all(r["taken"] == r["copies"] * r["size"] and r["copies"] <= 3 for r in got)
    assert sum(r["taken"] for r in got) <= sum(r["size"] for r in got)
    again = sorted((r["rk"], r["taken"]) for r in mixing.mix(edges.repartition(7)).collect())
    assert again == sorted((r["rk"], r["taken"]) for r in got)
