"""R1 — cluster rows by a key before a write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Partitions over which one key's rows are dealt when the count of partitions is fixed.
KEY_SPREAD = 8


def cluster_by(df: DataFrame, *keys: str, num_partitions: int | None = None) -> DataFrame:
    """Hash-cluster rows on ``keys`` so each output partition holds few key values.

    Without ``num_partitions`` this is a ``rebalance`` on the keys: adaptive execution
    sizes the partitions and splits one that a hot key (a store with a third of the
    orders) would make too large. With ``num_partitions`` (for example the number of
    warehouse connections) the count is fixed, which adaptive execution does not split: a
    key's rows are then dealt over up to ``KEY_SPREAD`` partitions by a hash of the row, so
    a hot key is no single task's. Both are deterministic, so a retried stage recomputes
    the same partitions.
    """
    if num_partitions:
        spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(KEY_SPREAD))
        return df.repartition(num_partitions, *keys, spread)
    return df.hint("rebalance", *keys)
