"""Readers for the driver's parquet tables.

Every reader names the columns it needs, so Catalyst prunes the parquet
``ReadSchema`` to exactly those columns and pushes filters into the scan.
The schemas are declared, so building a query reads no footers and runs no job.
Each call reads the table anew, so changed inputs are seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The driver tables' columns.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
DRIVER_TABLES = [*SCHEMAS, "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.schema(SCHEMAS[name]).parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df
