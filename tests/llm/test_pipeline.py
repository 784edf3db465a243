"""The pipeline: each stage's decisions on its own input, and the whole run."""

import corpus_pipeline
import pytest

from lienlake.llm import queries, toxicity
from lienlake.session import scratch_path

from .. import oracle_harness
from .conftest import SF
from .test_near_duplicates import brute_components, brute_leaks, brute_lines, rows_of


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_keep_the_columns(steps, documents):
    assert all(s.columns == documents.columns for s in steps[:-1])
    assert steps[-1].columns[: len(documents.columns)] == documents.columns


def test_toxic_documents_go(steps, documents, labels):
    scored = toxicity.score(documents, toxicity.fit(documents, labels))
    assert {r["doc_id"] for r in steps[0].collect()} == {r["doc_id"] for r in scored.filter("predicted = 0").collect()}


def test_repeated_lines_go(steps):
    gone = brute_lines(rows_of(steps[0]))
    want = {}
    for i, t in rows_of(steps[0]):
        kept = [x for j, x in enumerate(t.split("\n")) if (i, j) not in gone]
        if len(kept) == t.count("\n") + 1 or any(x.split() for x in kept):
            want[i] = "\n".join(kept)
    got = steps[1].collect()
    assert {r["doc_id"]: r["text"] for r in got} == want and all(r["n_chars"] == len(r["text"]) for r in got)


def test_one_of_each_group_stays(steps):
    want = {doc for doc, _, least in brute_components(rows_of(steps[1]), k=5, t=80) if doc == least}
    assert {r["doc_id"] for r in steps[2].collect()} == want


def test_near_copies_of_five_words_and_four_fifths_go(spark):
    """100 words and the same with 20 more: 96 of 116 shingles of five words."""
    base = " ".join(f"t{i}" for i in range(100))
    rows = [(1, base), (2, base + " " + " ".join(f"more{i}" for i in range(20))), (3, " ".join(f"u{i}" for i in range(100)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.ngram_join_stage(spark, docs, SF).collect()) == [1, 3]


def test_benchmark_passages_go(spark, steps):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = rows_of(steps[2])
    bad = {i for i, _ in brute_leaks([r for r in rows if len(r[1]) < 20_000], items)}
    kept = {r["doc_id"] for r in steps[3].collect()}
    assert kept & {i for i, t in rows if len(t) < 20_000} == {i for i, t in rows if len(t) < 20_000} - bad


def test_run_is_the_stages_in_turn(spark, steps):
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(str, got)) == sorted(map(str, steps[-1].collect()))
    assert all(r["mix_taken"] > 0 for r in got)


@pytest.mark.parametrize("name", sorted(queries.QUERY_SQL))
def test_queries_match_their_sql(spark, name):
    con = oracle_harness.duck_connect(SF)
    info = oracle_harness.compare(spark, con, name, queries.QUERIES[name], queries.QUERY_SQL[name], SF)
    assert info["status"] == "OK", info


def test_modules_are_registered():
    import __spark_entry__
    assert set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert [int(k[2:].split("_")[0]) for k in queries.QUERIES] == list(range(1, 14))
