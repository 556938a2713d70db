"""D2 as a Structured Streaming job: landed JSON days -> silver.

The stream follows the landed *files*: a binary-file source of which only paths are taken (the
content is not read), so a file without records, such as an empty day's ``[]``, is seen too, and a
file's path says its landing day in every layout (``day=<date>/...`` or ``<date>/data.json``). The
checkpoint tracks which files were processed, so a run picks up only days that arrived since the
last one; ``trigger(availableNow=True)`` makes it a bounded, restartable job that a daily scheduler
can call. Each micro-batch finds the landing days it touched and loads those whole days as the
batch job does (``larder.plans.feed.load_days``): a landing day owns its rows in silver, so late
records and records without a date stay where they were landed, a day split across micro-batches
ends up whole, and a failed batch is simply replayed. Days that the feed's manifest withdraws, or
declares complete without records, are dropped at the end of an ``availableNow`` run; a landing
folder that was archived changes nothing in silver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.feed import drop_emptied_days, load_days
from ..sessionconf import small_files_session
from ..sources import manifest
from ..sources.files import DAY_KEY, FEED_LAYOUTS, day_dir, day_pattern
from ..storage import exists, log_append, log_names, log_read

#: Names of landed files; the feed's manifest has none such.
FILES = "*.json*"
# The columns of Spark's binary-file source.
_BINARY = "path string, modificationTime timestamp, length long, content binary"


def feed_stream(spark: SparkSession, feed_root: str, *, layout: str = "day", max_files_per_trigger: int | None = None) -> DataFrame:
    """(day): the landing day of each file that arrives."""
    reader = (spark.readStream.format("binaryFile").schema(_BINARY).option("recursiveFileLookup", "true").option("pathGlobFilter", FILES))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    landed = reader.load(feed_root)
    return landed.select(F.to_date(F.nullif(F.regexp_extract("path", day_pattern(layout), 1), F.lit(""))).alias(DAY_KEY))


def _load_days(feed_root: str, silver_path: str, layout: str, loaded: set[dt.date]):
    def load(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        # One value for each landing day in the batch: folders, not rows.
        days: list[dt.date] = [r[0] for r in batch.where(F.col(DAY_KEY).isNotNull()).distinct().collect()]
        # A day archived since its file was listed keeps what silver has of it.
        load_days(spark, feed_root, [d for d in days if exists(spark, day_dir(feed_root, d, layout))], silver_path, layout=layout)
        loaded.update(days)
    return load


def start_feed_to_silver(spark: SparkSession, feed_root: str, silver_path: str, checkpoint: str,
                         *, layout: str = "day", available_now: bool = True, max_files_per_trigger: int | None = None,
                         loaded: set[dt.date] | None = None) -> StreamingQuery:
    """Start the stream; ``loaded`` is told the days of each micro-batch."""
    if layout not in FEED_LAYOUTS:
        raise ValueError(f"unknown feed layout {layout}")
    stream = feed_stream(small_files_session(spark), feed_root, layout=layout, max_files_per_trigger=max_files_per_trigger)
    writer = stream.writeStream.foreachBatch(_load_days(feed_root, silver_path, layout, set() if loaded is None else loaded)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_feed_to_silver(spark: SparkSession, feed_root: str, silver_path: str, checkpoint: str,
                       *, layout: str = "day", max_files_per_trigger: int | None = None) -> None:
    """Process every landed day not seen before, drop days the manifest takes back, then return.

    A file stream does not see a file that is written again under its old path. Days that the
    manifest declared since the last run and that no new file brought are loaded again, so a
    re-landed ``data.json`` needs its declaration.
    """
    spark, loaded = small_files_session(spark), set()
    query = start_feed_to_silver(spark, feed_root, silver_path, checkpoint, layout=layout, max_files_per_trigger=max_files_per_trigger, loaded=loaded)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()  # type: ignore[misc]
    position = f"{checkpoint.rstrip('/')}/manifest"
    seen = log_names(spark, position)
    last = log_read(spark, position, seen[-1]) if seen else ""
    entry, days = manifest.declared_since(spark, feed_root, last)
    again = [d for d in days if d not in loaded and exists(spark, day_dir(feed_root, d, layout))]
    load_days(spark, feed_root, again, silver_path, layout=layout)
    drop_emptied_days(spark, feed_root, silver_path)
    if entry != last:
        log_append(spark, position, entry)  # a run that failed before this loads the days again
