"""Declared primary and foreign keys, checked in one pass.

Every row of every table is expanded to the keys that it has under the declared
constraints - as a row with a primary key, as a parent and as a child - and these
are counted per (constraint, key): one scan a table and one shuffle for all
constraints, counted before it, so a key that a third of the rows has is one row
per task.  A primary key fails where a key is counted twice or is null; a foreign
key where children have no parent.  A null foreign key is no fault.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The source schema's keys (table -> column; child, column, parent).
PRIMARY_KEYS = {"customer": "customer_id", "scheme": "scheme_code", "mf_holding": "holding_id", "loan": "loan_id",
                "disbursement": "disbursement_id", "repayment": "repayment_id"}
FOREIGN_KEYS = [("mf_holding", "customer_id", "customer"), ("mf_holding", "scheme_code", "scheme"), ("loan", "customer_id", "customer"),
                ("disbursement", "loan_id", "loan"), ("repayment", "loan_id", "loan")]


def _keys(df: DataFrame, table: str, primary: Mapping[str, str], foreign: list) -> DataFrame | None:
    """(kind, child, column, parent, key, own, ref): how often a row has a key of its own or refers to one."""
    def entry(kind, child, column, parent, key, own, ref):
        return F.struct(F.lit(kind).alias("kind"), F.lit(child).alias("table_name"), F.lit(column).alias("column_name"),
                        F.lit(parent).cast("string").alias("parent_table"), F.col(key).cast("string").alias("key"),
                        F.lit(own).alias("own"), F.lit(ref).alias("ref"))
    found = [entry("primary", table, primary[table], None, primary[table], 1, 0)] if table in primary else []
    found += [entry("foreign", child, column, parent, primary[parent], 1, 0) for child, column, parent in foreign if parent == table]
    found += [entry("foreign", child, column, parent, column, 0, 1) for child, column, parent in foreign if child == table]
    return df.select(F.inline(F.array(*found))) if found else None


def check_constraints(tables: Mapping[str, DataFrame], primary: Mapping[str, str] = PRIMARY_KEYS, foreign: list = FOREIGN_KEYS) -> DataFrame:
    """One row per constraint: kind, table_name, column_name, parent_table, rows_checked, bad_keys, bad_rows, passed."""
    each = [k for t, df in tables.items() if (k := _keys(df, t, primary, foreign)) is not None]
    constraint = ("kind", "table_name", "column_name", "parent_table")
    counted = reduce(DataFrame.unionByName, each).groupBy(*constraint, "key").agg(F.sum("own").alias("own"), F.sum("ref").alias("ref"))
    is_primary, null = F.col("kind") == "primary", F.col("key").isNull()
    bad = F.when(is_primary, null | (F.col("own") > 1)).otherwise(~null & (F.col("ref") > 0) & (F.col("own") == 0))
    rows = F.when(is_primary, F.col("own")).otherwise(F.col("ref"))
    surplus = F.when(is_primary & ~null, F.col("own") - 1).otherwise(rows)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return counted.groupBy(*constraint).agg(
        total(rows).alias("rows_checked"), F.count_if(bad).cast("bigint").alias("bad_keys"), total(F.when(bad, surplus)).alias("bad_rows")
    ).withColumn("passed", F.col("bad_keys") == 0)
