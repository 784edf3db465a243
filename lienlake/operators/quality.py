"""Data-quality gates.

* Suites are ``{table: [(expectation, SQL predicate, hard)]}``.  A row
  violates a check when ``NOT (predicate)`` is TRUE, so rows where the
  predicate is NULL pass and an empty table passes.
* One aggregate per table computes the row count and every check's
  violation count in a single scan (``count_if``), instead of one scan per
  check; the counts are unpivoted with a generator into a report frame.
* Uniqueness and foreign-key checks pre-aggregate keys before they shuffle,
  so a key holding a third of the rows is one row per map task on the wire.
* ``enforce`` reads only the report (one row per check, a fixed bound) and
  raises on a hard failure.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Check = tuple[str, str, bool]

# The reference's gate suites (name, predicate, hard).
SILVER_SUITE: dict[str, list[Check]] = {
    "nav": [
        ("nav_positive", "nav > 0", True),
        ("nav_date_not_null", "nav_date IS NOT NULL", True),
    ],
    "customer": [
        ("pii_tokenized", "pan_token IS NOT NULL", True),
        ("kyc_status_valid", "kyc_status IN ('VERIFIED','PENDING','REJECTED')", True),
    ],
    "mf_holding": [
        ("units_non_negative", "units_pledged >= 0", True),
        ("lien_status_valid", "lien_status IN ('REQUESTED','MARKED','RELEASED','INVOKED')", False),
    ],
    "loan": [
        ("outstanding_non_negative", "outstanding >= 0", True),
    ],
}
GOLD_SUITE: dict[str, list[Check]] = {
    "fact_loan_daily": [
        ("ltv_cap_or_flagged", "drawing_power <= collateral_value OR collateral_value = 0", True),
        ("utilization_sane", "utilization_pct IS NULL OR utilization_pct >= 0", True),
        ("npa_bucket_valid", "npa_bucket IN ('CURRENT','1-30','31-60','61-90','90+')", True),
    ],
    "customer_360": [
        ("segment_valid", "segment IN ('PRIME','WATCH','STRESSED')", True),
    ],
}
SUITES = {"silver": SILVER_SUITE, "gold": GOLD_SUITE}

# The declarative suite for silver.nav.
NAV_COLUMN_SET = ["scheme_code", "isin", "nav", "nav_date", "published_at"]
NAV_NOT_NULL = ["scheme_code", "nav_date"]
NAV_KEY = ["scheme_code", "nav_date"]

REPORT_SCHEMA = ("layer string, table_name string, expectation string, hard boolean, "
                 "total_rows bigint, violations bigint, passed boolean")


class DataQualityError(RuntimeError):
    pass


def check_metrics(checks: Sequence[Check]) -> list:
    """The aggregates of a table's checks: rows, and violations of each check as v0, v1, ..."""
    return [F.count(F.lit(1)).alias("rows"), *(F.count_if(F.expr(f"NOT ({pred})")).alias(f"v{i}") for i, (_, pred, _) in enumerate(checks))]


def report_rows(metrics: Mapping[str, int], layer: str, table: str, checks: Sequence[Check]) -> list[dict]:
    """Report rows (the columns of REPORT_SCHEMA) from a table's observed metrics."""
    return [{"layer": layer, "table_name": table, "expectation": name, "hard": hard, "total_rows": int(metrics["rows"]),
             "violations": int(metrics[f"v{i}"]), "passed": not metrics[f"v{i}"]} for i, (name, _, hard) in enumerate(checks)]


def check_table(df: DataFrame, layer: str, table: str, checks: Sequence[Check]) -> DataFrame:
    """All checks of one table in one scan -> one report row per check."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count_if(F.expr(f"NOT ({pred})")).alias(f"_v{i}") for i, (_, pred, _) in enumerate(checks)]
    counts = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(name).alias("expectation"), F.lit(hard).alias("hard"),
                              F.col(f"_v{i}").alias("violations"))
                     for i, (name, _, hard) in enumerate(checks)])
    out = counts.select(F.col("_n").alias("total_rows"), F.inline(rows))
    return out.select(
        F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "expectation", "hard",
        F.col("total_rows").cast("bigint").alias("total_rows"),
        F.col("violations").cast("bigint").alias("violations"),
        (F.col("violations") == 0).alias("passed"))


def run_suite(tables: Mapping[str, DataFrame], layer: str,
              suite: Mapping[str, Sequence[Check]] | None = None) -> DataFrame:
    """The whole layer's report (one row per check)."""
    suite = suite if suite is not None else SUITES[layer]
    parts = [check_table(tables[t], layer, t, checks) for t, checks in suite.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def score(report: DataFrame) -> DataFrame:
    """Per layer: score = round(100 * passed / max(1, checks), 1)."""
    return report.groupBy("layer").agg(*_score(), F.count(F.lit(1)).alias("checks"))


def _score() -> list:
    return [F.round(100.0 * F.sum(F.col("passed").cast("int")) / F.greatest(F.count(F.lit(1)), F.lit(1)), 1).alias("dq_score"),
            F.count_if(F.col("hard") & ~F.col("passed")).cast("bigint").alias("hard_failures")]


def summary(report: DataFrame) -> DataFrame:
    """One JSON document per layer with its score, hard failures and results (sorted by table and expectation)."""
    result = F.struct(F.col("table_name").alias("table"), "expectation", "passed", "hard")
    results = F.sort_array(F.collect_list(result))
    one = report.groupBy("layer").agg(*_score(), results.alias("results"))
    return one.select("layer", F.to_json(F.struct("layer", "dq_score", "hard_failures", "results")).alias("summary"))


def enforce(report: DataFrame | Sequence[dict]) -> list[dict]:
    """Raise DataQualityError if any hard check failed; return the report rows.

    The report has one row per configured check, so collecting it is bounded."""
    rows = [r.asDict() for r in report.collect()] if isinstance(report, DataFrame) else list(report)
    failed = [r for r in rows if r["hard"] and not r["passed"]]
    if failed:
        names = ", ".join(f"{r['table_name']}.{r['expectation']}" for r in failed)
        raise DataQualityError(f"{len(failed)} hard quality check(s) failed: {names}")
    return rows


# ---- declarative expectations (D9-D12) ----------------------------------
def expect_columns_to_match_set(df: DataFrame, table: str, column_set: Sequence[str]) -> DataFrame:
    """Schema check, reported with the table's row count."""
    actual, wanted = set(df.columns), set(column_set)
    missing = ",".join(sorted(wanted - actual))
    unexpected = ",".join(sorted(actual - wanted))
    return df.agg(F.count(F.lit(1)).alias("element_count")).select(
        F.lit(table).alias("table_name"), F.lit("expect_table_columns_to_match_set").alias("expectation"),
        F.lit(actual == wanted).alias("success"), F.lit(missing).alias("missing"),
        F.lit(unexpected).alias("unexpected"), "element_count")


def expect_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """One row per column, single scan."""
    return check_table(df, "expectation", table,
                       [(f"not_null:{c}", f"{c} IS NOT NULL", True) for c in columns])


def expect_between(df: DataFrame, table: str, column: str, min_value=None, max_value=None,
                   strict_min: bool = False, strict_max: bool = False) -> DataFrame:
    """NULL values are not counted as unexpected (as in the gate rule)."""
    parts = []
    if min_value is not None:
        parts.append(f"{column} {'>' if strict_min else '>='} {min_value}")
    if max_value is not None:
        parts.append(f"{column} {'<' if strict_max else '<='} {max_value}")
    pred = " AND ".join(parts) or "TRUE"
    return check_table(df, "expectation", table, [(f"between:{column}", pred, True)])


def expect_unique(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Duplicate key groups and surplus rows for a (compound) key."""
    per_key = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_c"))
    dup = per_key.agg(
        F.count_if(F.col("_c") > 1).cast("bigint").alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c") - 1)), F.lit(0)).cast("bigint").alias("surplus_rows"),
        F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("total_rows"))
    return dup.select(F.lit(table).alias("table_name"), F.lit(",".join(columns)).alias("key_columns"),
                      "total_rows", "duplicate_keys", "surplus_rows",
                      (F.col("duplicate_keys") == 0).alias("passed"))


def expect_foreign_key(child: DataFrame, child_name: str, fk: str,
                       parent: DataFrame, parent_name: str, pk: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row.

    Child keys are counted per key first (partial aggregation), then
    anti-joined against the parent's distinct keys."""
    keys = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("_c"))
    ref = parent.select(F.col(pk).alias(fk)).distinct()
    orphans = keys.join(ref, fk, "left_anti")
    agg = orphans.agg(F.count(F.lit(1)).cast("bigint").alias("orphan_keys"),
                      F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("orphan_rows"))
    return agg.select(F.lit(child_name).alias("child_table"), F.lit(fk).alias("child_column"),
                      F.lit(parent_name).alias("parent_table"), F.lit(pk).alias("parent_column"),
                      "orphan_keys", "orphan_rows", (F.col("orphan_rows") == 0).alias("passed"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
