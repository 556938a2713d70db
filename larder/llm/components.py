"""Connected components by alternating large-star and small-star steps.

Kiveris et al., "Connected components in MapReduce and beyond" (2014). Both steps are
joins and partial aggregates on an edge table; every round is written to the shared
folder, so a lost executor repeats one round at most and lineage stays short.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import remove, scratch_path

MAX_ROUNDS = 100

#: Writes a table to the shared folder and reads it back.
Store = Callable[[DataFrame], DataFrame]


def _star(edges: DataFrame, store: Store) -> DataFrame:
    """For edges (src, dst): every src with the smallest of itself and its dsts. It is stored, as
    a join with an aggregate of the same stage cannot split the edges of a hub."""
    return store(edges.groupBy("src").agg(F.min("dst").alias("low")).select("src", F.least("src", "low").alias("low")))


def _large(edges: DataFrame, store: Store) -> DataFrame:
    both = edges.union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return (both.join(_star(both, store), "src").where(F.col("dst") > F.col("src"))
            .select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct())


def _small(edges: DataFrame, store: Store) -> DataFrame:
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).where("src <> dst")
    low = _star(down, store)
    moved = down.join(low, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.union(low.select("src", F.col("low").alias("dst"))).where("src <> dst").distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(src, dst) long edges -> (node, root): each node's smallest reachable node.

    Nodes without an edge to another node do not appear; self loops and repeated edges
    are harmless, null ends are ignored, no edges give no rows.
    """
    spark = edges.sparkSession
    stored: list[str] = []

    def store(df: DataFrame) -> DataFrame:
        stored.append(scratch_path(spark, name))
        df.write.parquet(stored[-1])
        return spark.read.schema(df.schema).parquet(stored[-1])

    def write(df: DataFrame) -> DataFrame:
        out = store(df)
        for path in stored[:-1]:  # the round before and its stars are not needed any more
            remove(spark, path)
        del stored[:-1]
        return out

    now = write(edges.where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst")
                      .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    before = _digest(now)
    for _ in range(MAX_ROUNDS if before[0] else 0):
        now = write(_small(_large(now, store), store))
        after = _digest(now)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("src").alias("node"), F.col("dst").alias("root")).union(
        now.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct())
