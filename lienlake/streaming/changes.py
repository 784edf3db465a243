"""Change-log apply.

A change record is ``(op, seq, key, row)`` with op in r (snapshot read),
c (create), u (update), d (delete); ``seq`` orders the changes of a key.

The table is keyed state: per key the record with the highest ``(seq, op)`` seen
so far, *including* deletes (kept as tombstones), so an older update arriving
after a delete cannot resurrect the row.  A micro-batch writes the keys that it
changes and nothing else; a replayed one leaves the same state.  The serving
view reads the last committed state through Spark's state data source and drops
tombstones.  The query's output is the log of the changes that took effect.
Records that can't be decoded go to a dead-letter table by a query of their own.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .margin import run_to_files, use_state_store

OPS = ["r", "c", "u", "d"]


def change_schema(row_ddl: str, key_type: str = "bigint") -> str:
    return f"op string, seq bigint, key {key_type}, row struct<{row_ddl}>"


def encode_changes(changes: DataFrame) -> DataFrame:
    return changes.select(F.to_json(F.struct("op", "seq", "key", "row")).alias("value"))


def decode_changes(raw: DataFrame, schema: str) -> DataFrame:
    """All messages, decoded; ``bad`` holds the text of those that are no change record."""
    p = raw.select("value", F.from_json("value", schema).alias("c"))
    ok = F.coalesce(F.col("c.op").isin(*OPS) & F.col("c.seq").isNotNull() & F.col("c.key").isNotNull(), F.lit(False))
    return p.select("c.*", F.when(~ok, F.coalesce("value", F.lit(""))).alias("bad"))


class ChangeProcessor(StatefulProcessor):
    """The newest record of a key; rows are compared as they come and none is kept but the newest."""

    def __init__(self, row_type: str):
        self.row_type = row_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", f"seq bigint, op string, row {self.row_type}")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = best = self.newest.get()
        for r in rows:
            if best is None or (r.seq, r.op) > (best[0], best[1]):
                best = (r.seq, r.op, r.row)
        if best is not before:
            self.newest.update(best)
            yield Row(key=key[0], seq=best[0], op=best[1])

    def close(self) -> None:
        pass


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def apply_changes(changes: DataFrame) -> DataFrame:
    """The changes that took effect (key, seq, op), one per key and micro-batch; the rows are state."""
    good = changes.filter("bad is null").select("key", "seq", "op", "row")
    row_type, key_type = (changes.schema[c].dataType.simpleString() for c in ("row", "key"))
    return good.groupBy("key").transformWithState(ChangeProcessor(row_type), f"key {key_type}, seq bigint, op string", "Append", "None")


def run_apply_changes(changes: DataFrame, root: str, name: str, checkpoint: str):
    """Drain a change stream: state in ``checkpoint``, the log of effective changes and the undecodable records as tables."""
    use_state_store(changes.sparkSession)
    run_to_files(changes.filter("bad is not null").select("bad"), f"{root}/{name}_rejected", f"{checkpoint}_rejected")
    return run_to_files(apply_changes(changes), f"{root}/{name}_applied", checkpoint)


def current_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Serving view: live rows only, flattened."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "newest").load()
    live = state.select("key.key", "value.seq", "value.op", "value.row").filter(F.col("op") != "d")
    return live.select("key", "seq", "row.*")
