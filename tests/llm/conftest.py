import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def split_words(text):
    """Words of the contracts: runs of characters other than space and 9 to 13."""
    return [w.decode() for w in (text or "").encode().split()]


@pytest.fixture(scope="session")
def tables():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()),
                       T.StructField("rk", T.IntegerType()), T.StructField("size", T.StringType())])

#: A long text, one of a single word, empty and blank ones, nulls in each column, repeated rows, an id with two texts.
LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(60_000))


def edge_rows():
    rng = random.Random(5)
    base = [f"t{rng.randrange(400)}" for _ in range(120)]
    near = list(base)
    near[60] = "changed"
    rows = [(1, " ".join(base)), (2, " ".join(near)), (2, " ".join(near)), (3, None), (4, ""), (5, " \t\n "), (6, "word"), (7, LONG),
            (None, " ".join(base)), (None, None), (8, "Word"), (9, "a\n\n\nb c d\nb c d"), (9, " ".join(base[::-1])), (10, "a b c d e f g h i " * 40)]
    return [(i, t, None if n % 3 == 0 else "en", None if n % 4 == 0 else f"s{n % 2}", None, "x", n, None) for n, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def mixed(documents, edges):
    """The documents of the smallest tables with the edge rows (their ids moved out of the way)."""
    plain = edges.select((F.col("doc_id") + 100_000).alias("doc_id"), "text", "lang", "source", "n_chars")
    return documents.unionByName(plain)
