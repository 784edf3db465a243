"""Join helpers.

No join here is forced to broadcast: Catalyst decides from file sizes and AQE
from measured shuffle sizes, and AQE splits a hot key of a sort-merge join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def semi_join_valid(df: DataFrame, valid: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Keep rows whose key exists in ``valid`` (a LEFT SEMI join).

    Distinct keys are pre-aggregated before the join so a duplicated key on
    the reference side is shuffled once; the semi join never duplicates rows
    and needs no projection back.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(valid.select(*keys).distinct(), keys, "left_semi")
