"""Latest row per key (W1) and deduplication helpers.

``latest`` keeps, for every key, the row that is greatest on ``order_cols``
(all descending, NULLs last), breaking any remaining tie on the other
columns so the result is deterministic.

Plan: one hash/sort aggregate of ``max(struct(order..., rest...))``.  The
aggregate is computed partially on the map side before the shuffle, so each
map task ships at most one row per key: a key holding a third of all rows
costs one row per map partition on the wire, not a third of the data in one
reducer.  (A ``row_number`` window would sort every row of the group.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str] | str,
           co_keys: Sequence[str] = ()) -> DataFrame:
    """``co_keys``: columns the key determines (constant within a key), added
    to the grouping so that an existing partitioning on them - e.g. from a
    join on that column just upstream - satisfies the aggregation and no new
    shuffle is needed.  Groups are unchanged because the key determines them."""
    if isinstance(order_cols, str):
        order_cols = [order_cols]
    keys = list(keys) + [c for c in co_keys if c in df.columns and c not in keys]
    order_cols = list(order_cols)
    payload = [c for c in df.columns if c not in keys]
    ranked = order_cols + [c for c in payload if c not in order_cols]
    best = F.max(F.struct(*[F.col(c) for c in ranked])).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])
