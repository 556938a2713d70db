"""A session for work on thousands of small partition folders.

Per-file work, not data volume, decides the cost of a multi-year backfill of small days.
None of the settings changes anything for large data:

- adaptive execution's coalescing floor is lowered, so a small partitioned write still
  spreads its folders over all cores (large writes keep the advisory partition size);
- it aims at a few tasks per core, as tasks of one per core come out uneven and the last
  ones run alone;
- many folders are listed with a few tasks per core instead of one per folder.

They are set on a session of its own (same context, catalog settings copied), so flows in
other threads that share the caller's session are not affected.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

MIN_PARTITION_CONF = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
MIN_TASKS_CONF = "spark.sql.adaptive.coalescePartitions.minPartitionNum"
LISTING_PARALLELISM_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
SMALL_WRITE_FLOOR = "1k"
TASKS_PER_CORE = 4
_MARK = "spark.larder.smallFiles"


def small_files_session(spark: SparkSession) -> SparkSession:
    """A new session with ``spark``'s SQL settings and the settings above (itself if it is one)."""
    if spark.conf.get(_MARK, None):
        return spark
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set(MIN_PARTITION_CONF, SMALL_WRITE_FLOOR)
    own.conf.set(MIN_TASKS_CONF, str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    own.conf.set(LISTING_PARALLELISM_CONF, str(max(8, 2 * spark.sparkContext.defaultParallelism)))
    own.conf.set(_MARK, "true")
    return own
