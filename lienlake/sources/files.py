"""File sources: CSV with an explicit schema (S1, S4) and bronze landing.

CSV is always read with a declared schema: no inference pass over the data,
identifiers keep their leading zeros, and the batch and stream sides agree on
types.  ``mode`` chooses between PERMISSIVE (bad rows kept, optionally with
the raw text in ``_corrupt_record``), DROPMALFORMED and FAILFAST (strict
positional load).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COL = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST",
             keep_corrupt: bool = False, header: bool = True) -> DataFrame:
    if keep_corrupt:
        schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, T.StringType())])
    r = (spark.read.schema(schema).option("header", header).option("mode", mode)
         .option("enforceSchema", True))
    if keep_corrupt:
        r = r.option("columnNameOfCorruptRecord", CORRUPT_COL)
    return r.csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("errorifexists").option("header", True).csv(path)
    return path


def stamp_lineage(df: DataFrame, source: str, ingested_at: dt.datetime | None = None,
                  with_file: bool = False) -> DataFrame:
    """Source label and ingest time (caller-supplied for reproducible reruns)."""
    ts = F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
    out = df.withColumns({"_source": F.lit(source), "_ingested_at": ts})
    if with_file:
        out = out.withColumn("_file", F.col("_metadata.file_path"))
    return out
