"""Helpers shared by the operators: row keys, word columns, lineage cuts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_dir, scratch_path

#: White space that separates words: space and the control characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A driver table, reduced to the columns named (so that clashing extra columns never reach an operator)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


#: Folders that ``cut`` has written in this process.
CUTS: list[str] = []


def clear_cuts(paths: list[str], docs: DataFrame) -> None:
    """Remove the folders of cuts that nothing needs any more, but those that ``docs`` is read from."""
    files = docs.inputFiles()
    for p in paths:
        if not any(p.split("/")[-2] in f for f in files):  # the folder's own name; how a path is spelled may differ
            remove_dir(docs.sparkSession, p)
            CUTS.remove(p)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages restart from the files, not from
    the lineage, when an executor is lost.  Shuffle files go when the driver has collected the plans that made
    them, so it is asked to collect."""
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    CUTS.append(path)
    df.write.parquet(path)
    spark.sparkContext._jvm.java.lang.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """One long for a row: rows with the same id and the same text share it (they are the same document),
    rows with a null id are told apart by their text."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def text_or_empty(text_col: str = "text") -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def words(text: Column, pattern: str = SPACE) -> Column:
    """The words of a text as an array: what stands between matches of ``pattern``, in order."""
    return F.array_remove(F.split(text, pattern), "")


def crc_bucket(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def labelled_sample(labels: DataFrame, label_col: str, id_col: str, modulus: int, held_out: int, rows: int) -> DataFrame:
    """(id, label) of about ``rows`` labelled ids at most, chosen by a hash of the id, none of them held out (crc32 of
    the id as text, modulo ``modulus``).  An id with several labels counts once, with the largest."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (crc_bucket(id_col, modulus) != held_out))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    share = min(1.0, rows / max(known.count(), 1))
    return known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)))


def memo(function):
    """Keep a function's results.  Unlike ``functools.cache`` it is shipped by value, so executors need no installed copy."""
    seen: dict = {}

    def run(*args):
        if args not in seen:
            seen[args] = function(*args)
        return seen[args]
    return run


class Among:
    """A bitmap of the longs in a column, to leave out rows before they are shuffled for a join.

    It has ``BITS`` bits (8 MB) at most whatever it holds, fewer for few values: made by an aggregation of at most 2,048
    rows, and sent with the plan.  Other values can pass it, more the more it holds, so the join must follow.  The longs
    must be hashes."""

    BITS, SPARSE = 1 << 26, 64

    def __init__(self, wanted: DataFrame, column: str):
        place = F.pmod(F.col(column), F.lit(self.BITS)) + 1
        parts = wanted.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("m"))
        self.bits = np.zeros(self.BITS // 8, np.uint8)
        for r in parts.collect():
            self.bits[(r["b"] - 1) * 4096 : r["b"] * 4096] = np.frombuffer(r["m"], np.uint8)
        ones = int(np.bitwise_count(self.bits).sum())
        while len(self.bits) > 4096 and self.SPARSE * ones <= 4 * len(self.bits):
            half = len(self.bits) // 2
            self.bits = self.bits[:half] | self.bits[half:]

    def of(self, batch, column: str):
        """The rows of an Arrow batch whose long may be among the wanted ones."""
        import pyarrow as pa

        at = batch.column(column).to_numpy(zero_copy_only=False) & (8 * len(self.bits) - 1)
        return batch.filter(pa.array((self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))


def among(df: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``df`` whose hash in ``column`` is among those of ``wanted`` (same name), and a few others."""
    bitmap = Among(wanted, column)

    def run(batches):
        for batch in batches:
            yield bitmap.of(batch, column)
    return df.mapInArrow(run, df.schema)
