"""D2 — the manifest of a daily feed: which landing days are complete, and which are withdrawn.

A log under the feed's root (``_days``, invisible to readers of the feed) holds an entry for each
landing: its days, with the number of records and whether the day is complete or withdrawn. The
last word on a day counts. Retention may archive landing folders at will: only a withdrawal, or a
complete day without records, takes a day's rows out of silver.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import log_append, log_names

FOLDER = "_days"
COMPLETE, WITHDRAWN = "complete", "withdrawn"
SCHEMA = "day date, records long, state string"


def _folder(feed_root: str) -> str:
    return f"{feed_root.rstrip('/')}/{FOLDER}"


def declare(spark: SparkSession, feed_root: str, records: Mapping[dt.date | str, int]) -> None:
    """Days that are landed whole, with their number of records (repeated ones counted)."""
    lines = [json.dumps({"day": str(d), "records": n, "state": COMPLETE}) for d, n in records.items()]
    if lines:
        log_append(spark, _folder(feed_root), "\n".join(lines))


def withdraw(spark: SparkSession, feed_root: str, days: Iterable[dt.date | str]) -> None:
    """Days whose records are taken back; the next load or stream run removes them from silver."""
    lines = [json.dumps({"day": str(d), "records": 0, "state": WITHDRAWN}) for d in days]
    if lines:
        log_append(spark, _folder(feed_root), "\n".join(lines))


def manifest(spark: SparkSession, feed_root: str) -> DataFrame:
    """(day, records, state): the last entry of each day; no rows without a manifest."""
    folder = _folder(feed_root)
    names = log_names(spark, folder)
    if not names:
        return spark.createDataFrame([], SCHEMA)
    entries = spark.read.schema(SCHEMA).json([f"{folder}/{n}" for n in names])
    entry = F.regexp_extract(F.col("_metadata.file_path"), "/([0-9]+)$", 1).cast("long")
    return (entries.groupBy("day").agg(F.max_by(F.struct("records", "state"), F.struct(entry, F.col("_metadata.file_block_start"))).alias("last"))
            .select("day", "last.records", "last.state"))


def declared_since(spark: SparkSession, feed_root: str, entry: str) -> tuple[str, list[dt.date]]:
    """The last entry's name, and the days that entries after ``entry`` declare complete."""
    folder = _folder(feed_root)
    names = [n for n in log_names(spark, folder) if n > entry]
    if not names:
        return entry, []
    later = spark.read.schema(SCHEMA).json([f"{folder}/{n}" for n in names]).where(F.col("state") == COMPLETE)
    return names[-1], sorted(r["day"] for r in later.select("day").distinct().collect())


def emptied(spark: SparkSession, feed_root: str) -> list[dt.date]:
    """Days that the manifest leaves without rows: withdrawn, or complete without records."""
    rows = manifest(spark, feed_root).where(F.col("state").eqNullSafe(WITHDRAWN) | (F.col("records") == 0)).select("day").collect()
    return sorted(r["day"] for r in rows)


def check_complete(spark: SparkSession, feed_root: str, landed: DataFrame, day_col: str, days: Iterable[dt.date]) -> None:
    """Refuse days whose landed records are not as many as the manifest says (a landing cut short)."""
    declared = manifest(spark, feed_root).where((F.col("state") == COMPLETE) & F.col("day").isin(list(days)))
    if declared.isEmpty():
        return
    found = landed.groupBy(F.col(day_col).alias("day")).count()
    wrong = (declared.join(found, "day", "left").where(F.coalesce("count", F.lit(0)) != F.col("records"))
             .orderBy("day").limit(5).collect())
    if wrong:
        raise ValueError("incomplete landing days: " + ", ".join(f"{r['day']} has {r['count'] or 0} of {r['records']} records" for r in wrong))
