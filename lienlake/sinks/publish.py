"""Publishing tables to a lake root on shared storage.

Layout under ``Lake.root`` (default: ``lake_root(spark)``)::

    tables/<layer>/<name>/v=<version>/     full-refresh versions (K1)
    snapshots/<layer>/<name>/as_of_date=*/ daily partitions (K3)
    audit/                                 one row per publish (K9)

Full refresh never overwrites the data that readers (or the writing plan
itself) may be reading: it writes a new version directory and then makes it
current.  The newest version with a ``_SUCCESS`` marker is current, so a
failed or half-written job leaves the previous version in place; optionally
a catalog table is repointed (``ALTER TABLE .. SET LOCATION``, a metadata
change).  Row counts for the audit come from an ``Observation`` on the write
itself (no second scan), and so do the violation counts of quality checks: a
table with checks is written to a staging directory first and published by a
rename, and only if no hard check failed.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..session import lake_root, list_dirs, move_dir, path_exists
from .scd2_table import Scd2Table

AUDIT_SCHEMA = ("layer string, table_name string, version string, as_of_date date, "
                "row_count bigint, committed_at timestamp, path string")


#: Compression of published tables.
CODEC = "zstd"


def new_version() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]


class Lake:
    def __init__(self, spark: SparkSession, root: str | None = None, use_catalog: bool = False,
                 autoflush: bool = True):
        self.spark = spark
        self.root = (root or lake_root(spark)).rstrip("/")
        self.use_catalog = use_catalog
        self.autoflush = autoflush      # False: audit rows are written by flush_audit()
        self._pending: list[tuple] = []
        self._audit_lock = threading.Lock()   # publishes may run in parallel threads

    # ---- locations ------------------------------------------------------
    def table_dir(self, layer: str, name: str) -> str:
        return f"{self.root}/tables/{layer}/{name}"

    def snapshot_dir(self, layer: str, name: str) -> str:
        return f"{self.root}/snapshots/{layer}/{name}"

    # ---- catalog (K10, K11) --------------------------------------------
    def ensure_namespace(self, layer: str) -> None:
        self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {layer}")

    def exists(self, layer: str, name: str) -> bool:
        if self.use_catalog and self.spark.catalog.tableExists(f"{layer}.{name}"):
            return True
        try:
            self.current_path(layer, name)
            return True
        except FileNotFoundError:
            return False

    def _point_catalog(self, layer: str, name: str, path: str) -> None:
        self.ensure_namespace(layer)
        fq = f"{layer}.{name}"
        if self.spark.catalog.tableExists(fq):
            self.spark.sql(f"ALTER TABLE {fq} SET LOCATION '{path}'")
            self.spark.sql(f"REFRESH TABLE {fq}")
        else:
            self.spark.sql(f"CREATE TABLE {fq} USING parquet LOCATION '{path}'")

    # ---- writes ---------------------------------------------------------
    def _audit(self, layer: str, name: str, version: str, rows: int, path: str,
               as_of: dt.date | None = None) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        with self._audit_lock:
            self._pending.append((layer, name, version, as_of, int(rows or 0), now, path))
        if self.autoflush:
            self.flush_audit()

    def flush_audit(self) -> None:
        """Append the buffered audit rows (one small file per flush).  Appends
        to the audit directory are serialized: concurrent appends to one path
        would share a staging directory."""
        with self._audit_lock:
            if not self._pending:
                return
            rows, self._pending = self._pending, []
            (self.spark.createDataFrame(rows, AUDIT_SCHEMA).coalesce(1)
             .write.mode("append").parquet(f"{self.root}/audit"))

    def publish_replace(self, df: DataFrame, layer: str, name: str, audit: bool = True) -> str:
        """K1: write a new version and make it current.  Returns its path."""
        version = new_version()
        path = f"{self.table_dir(layer, name)}/v={version}"
        obs = Observation(f"publish_{layer}_{name}_{version}")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").option("compression", CODEC).parquet(path)
        if self.use_catalog:
            self._point_catalog(layer, name, path)
        if audit:
            self._audit(layer, name, version, obs.get["rows"], path)
        return path

    def publish_checked(self, df: DataFrame, layer: str, name: str, checks: Sequence[quality.Check], snapshot: bool = False,
                        partition_col: str = "as_of_date") -> list[dict]:
        """K1/K3 behind a gate (D1): the checks are counted while the table is written, and it is published unless a hard one
        failed (it then stays in staging).  Returns the report's rows; the caller raises on them."""
        version = new_version()
        staged = f"{self.root}/staging/{layer}/{name}/{version}"
        obs = Observation(f"checked_{layer}_{name}_{version}")
        metrics = quality.check_metrics(checks) + ([F.max(partition_col).alias("as_of")] if snapshot else [])
        writer = df.observe(obs, *metrics).write.mode("errorifexists").option("compression", CODEC)
        (writer.partitionBy(partition_col) if snapshot else writer).parquet(staged)
        report = quality.report_rows(obs.get, layer, name, checks)
        if any(r["hard"] and not r["passed"] for r in report):
            return report
        path = self.snapshot_dir(layer, name) if snapshot else f"{self.table_dir(layer, name)}/v={version}"
        if snapshot:
            for part in list_dirs(self.spark, staged):
                move_dir(self.spark, f"{staged}/{part}", f"{path}/{part}")
        else:
            move_dir(self.spark, staged, path)
            if self.use_catalog:
                self._point_catalog(layer, name, path)
        self._audit(layer, name, version, obs.get["rows"], path, obs.get.get("as_of") if snapshot else None)
        return report

    def publish_create(self, df: DataFrame, layer: str, name: str) -> str:
        """K2: first load; refuses to replace an existing table."""
        if self.exists(layer, name):
            raise FileExistsError(f"{layer}.{name}")
        return self.publish_replace(df, layer, name)

    def scd2(self, layer: str, name: str, key: str = "customer_id") -> Scd2Table:
        """A dimension with history, changed in place."""
        return Scd2Table(self.spark, f"{self.root}/scd2/{layer}/{name}", key)

    def publish_snapshot(self, df: DataFrame, layer: str, name: str,
                         partition_col: str = "as_of_date") -> str:
        """K3: replace only the partitions present in ``df`` (rerun-safe history)."""
        path = self.snapshot_dir(layer, name)
        obs = Observation(f"snapshot_{layer}_{name}_{uuid.uuid4().hex[:8]}")
        (df.observe(obs, F.count(F.lit(1)).alias("rows"), F.max(partition_col).alias("as_of"))
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
           .partitionBy(partition_col).parquet(path))
        m = obs.get
        self._audit(layer, name, new_version(), m["rows"], path, m.get("as_of"))
        return path

    # ---- reads ----------------------------------------------------------
    def current_path(self, layer: str, name: str) -> str:
        base = self.table_dir(layer, name)
        versions = [d for d in list_dirs(self.spark, base) if d.startswith("v=")]
        for v in reversed(versions):
            if path_exists(self.spark, f"{base}/{v}/_SUCCESS"):
                return f"{base}/{v}"
        raise FileNotFoundError(f"no published version of {layer}.{name} under {self.root}")

    def read(self, layer: str, name: str) -> DataFrame:
        """The current version of a full-refresh table."""
        if self.use_catalog and self.spark.catalog.tableExists(f"{layer}.{name}"):
            return self.spark.table(f"{layer}.{name}")
        return self.spark.read.parquet(self.current_path(layer, name))

    def read_snapshot(self, layer: str, name: str, as_of=None) -> DataFrame:
        """Snapshot table, optionally one as_of partition (partition-pruned)."""
        df = self.spark.read.parquet(self.snapshot_dir(layer, name))
        if as_of is not None:
            df = df.filter(F.col("as_of_date") == as_of)
        return df

    def audit(self) -> DataFrame:
        """K9: publish history, newest first."""
        path = f"{self.root}/audit"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], AUDIT_SCHEMA)
        return (self.spark.read.schema(AUDIT_SCHEMA).parquet(path)
                .orderBy(F.col("committed_at").desc(), "table_name"))


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Labelled row counts, one small aggregate per table, stacked."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count") for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
