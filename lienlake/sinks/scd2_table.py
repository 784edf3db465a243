"""The SCD2 dimension as a table that a run changes in place.

Layout under ``path``::

    current/bucket=<k>/          current rows, by a hash of the key
    closed/scd_valid_to=<day>/   closed versions, by the day that closed them
    delta/                       the last run's changes (key, old and new version)

A run joins the stage with the current rows only.  What changed is written as
the run's delta; then the day's closed partition and the buckets with changed
keys are replaced (dynamic partition overwrite) and no other file is touched:
closed history is neither read nor written again, but for the run's own day.

A run that broke off can be repeated: versions are told by (key, valid_from), so
closing one twice leaves one, and a bucket that is current already has nothing
to change.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scd2 import check_unique_keys
from ..session import list_dirs


class Scd2Table:
    def __init__(self, spark: SparkSession, path: str, key: str = "customer_id", hash_col: str = "_hash", buckets: int = 64):
        self.spark, self.path, self.key, self.hash_col, self.buckets = spark, path.rstrip("/"), key, hash_col, buckets

    def _has(self, part: str) -> bool:
        return any("=" in d for d in list_dirs(self.spark, f"{self.path}/{part}"))

    def exists(self) -> bool:
        return self._has("current")

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def current(self) -> DataFrame:
        """Current rows, with their bucket."""
        return self.spark.read.parquet(f"{self.path}/current")

    def _closed(self, columns: Sequence[str]) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.path}/closed").select(*columns) if self._has("closed") else None

    def read(self) -> DataFrame:
        """All versions."""
        now = self.current().drop("bucket")
        before = self._closed(now.columns)
        return now if before is None else now.unionByName(before)

    def _overwrite(self, rows: DataFrame, part: str, by: str) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(f"{self.path}/{part}"))

    def changes(self, stage: DataFrame, run_date) -> DataFrame:
        """(key, bucket, old, new) of the stage's rows that are new or differ from the current version (old: null if none)."""
        attrs = [c for c in stage.columns if c != self.key]
        run = F.lit(str(run_date)).cast("date")
        old = self.current().select(self.key, F.struct(*attrs, "scd_valid_from").alias("old"))
        new = F.struct(*attrs, run.alias("scd_valid_from"), F.lit(None).cast("date").alias("scd_valid_to"), F.lit(True).alias("is_current"))
        j = stage.select(self.key, new.alias("new")).join(old, self.key, "left")
        return (j.filter(F.col("old").isNull() | (F.col(f"old.{self.hash_col}") != F.col(f"new.{self.hash_col}")))
                .select(self.key, self._bucket().alias("bucket"), "old", "new"))

    def apply(self, stage: DataFrame, run_date) -> None:
        """Merge a stage as of ``run_date``; the first one loads the table.  Rows that the stage lacks stay current."""
        check_unique_keys(stage, self.key)
        run = F.lit(str(run_date)).cast("date")
        if not self.exists():
            first = stage.withColumns({"scd_valid_from": run, "scd_valid_to": F.lit(None).cast("date"), "is_current": F.lit(True),
                                       "bucket": self._bucket()})
            self._overwrite(first, "current", "bucket")
            return
        self.changes(stage, run_date).write.mode("overwrite").parquet(f"{self.path}/delta")
        delta = self.spark.read.parquet(f"{self.path}/delta")
        touched = [r["bucket"] for r in delta.select("bucket").distinct().collect()]  # as many as there are buckets at most
        if not touched:
            return
        columns = [c for c in self.current().columns if c != "bucket"]
        shut = {"scd_valid_to": run, "is_current": F.lit(False)}
        closed = delta.filter("old is not null").select(self.key, "old.*").withColumns(shut).select(*columns)
        before = self._closed(columns)
        if before is not None:
            closed = closed.unionByName(before.filter(F.col("scd_valid_to") == run)).dropDuplicates([self.key, "scd_valid_from"])
        self._overwrite(closed, "closed", "scd_valid_to")
        kept = self.current().filter(F.col("bucket").isin(touched)).join(delta.select(self.key), self.key, "left_anti")
        fresh = delta.select(self.key, "bucket", "new.*")
        self._overwrite(kept.unionByName(fresh), "current", "bucket")
