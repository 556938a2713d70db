"""One key holding a third of the rows: results stay whole and the hot key is split.

Adaptive execution's skew thresholds are lowered inside each test so that a few
thousand rows count as skewed (on a cluster the defaults apply to real partition sizes).
"""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import functions as F

from larder.operators import joins, relational as rel, setops
from larder.sinks import files as sinks

SKEW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@contextmanager
def settings(spark, values):
    """The test session's own settings, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _hot_table(spark, n=30_000):
    # A third of the rows share key 0; the rest spread over 1,000 keys.
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).cast("int").alias("k"),
        F.col("id").alias("v"),
    )


def test_lookup_join_fallback_splits_the_hot_key(spark):
    facts = _hot_table(spark)
    lookup = spark.range(1001).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    with settings(spark, SKEW):
        out = joins.left_lookup(facts, lookup, {"k": "k"}, {"name": "name"})
        rows = out.collect()
        final = out._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 30_000
    assert sum(1 for r in rows if r.name == "n0") == 10_000
    assert "SortMergeJoin" in final and "skew=true" in final


def test_dedup_of_a_hot_row_stays_exact(spark):
    hot = _hot_table(spark).select("k")
    assert rel.dedup_rows(hot).count() == 1001


def test_bag_difference_of_a_hot_row(spark):
    hot = _hot_table(spark).select("k")
    once = rel.dedup_rows(hot)
    out = setops.bag_difference(hot, once, chunk_rows=1_000)
    assert out.count() == 30_000 - 1001
    assert out.where("k = 0").count() == 9_999


def test_rebalanced_partitioned_write_splits_the_hot_folder(spark, out):
    df = _hot_table(spark)
    with settings(spark, SKEW):
        sinks.write_parquet(df, out, partition_by="k")
    hot_files = [f for f in os.listdir(f"{out}/k=0") if f.endswith(".parquet")]
    assert len(hot_files) > 1
    assert spark.read.parquet(out).count() == 30_000


def test_lookup_join_with_a_third_null_keys(spark):
    facts = _hot_table(spark).select(F.when(F.col("k") == 0, F.lit(None)).otherwise(F.col("k")).alias("k"), "v")
    lookup = spark.range(1, 1001).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("name"))
    with settings(spark, SKEW):
        out = joins.left_lookup(facts, lookup, {"k": "k"}, {"name": "name"})
        rows = out.collect()
        final = out._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 30_000
    assert sum(1 for r in rows if r.k is None and r.name is None) == 10_000
    assert "skew=true" in final


def test_counted_clustering_splits_the_hot_key(spark):
    from larder.operators.partitioning import cluster_by

    sizes = cluster_by(_hot_table(spark), "k", num_partitions=16).rdd.glom().map(len).collect()
    assert sum(sizes) == 30_000 and max(sizes) < 10_000 / 2
