"""The out-of-stock feed in silver: a landing day owns its rows.

Silver is partitioned by the day a record was landed on and by the event date it carries
(``day=.../date=...``). Loading a landing day replaces exactly that day's partitions and
drops those it no longer has, so a late record (landed after its event date) never touches
the rows other days brought, a record without a date stays with its day, and a day landed
again, even empty, leaves nothing of the earlier landing. A day whose landing folder was
archived keeps its rows: only the feed's manifest (``larder.sources.manifest``) takes a day
back. One event may be landed on several days: readers take distinct (product, date) pairs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts
from ..operators.relational import distinct
from ..sinks.files import write_parquet_daily
from ..sources import manifest
from ..sources.files import DAY_KEY, read_json_days, read_parquet
from ..storage import children, remove

TABLE = "out_of_stock"
SCHEMA = {**contracts.BRONZE[TABLE], DAY_KEY: {"type": contracts.DATE, "nullable": False}}
#: Folder name of a NULL partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _event_dates(spark: SparkSession, day_path: str) -> set[dt.date | None]:
    values = [n.partition("=")[2] for n in children(spark, day_path) if n.startswith("date=")]
    return {None if v == NULL_FOLDER else dt.date.fromisoformat(v) for v in values}


def load_days(spark: SparkSession, feed_root: str, days: Iterable[dt.date], silver_path: str, *, layout: str = "day") -> list[dt.date | None]:
    """Replace the given landing days in silver; returns the event dates that may have changed.

    Rows are de-duplicated within a landing day; a day whose file holds no record (``[]``) loses
    its rows. A day with another number of records than the feed's manifest declares is refused.
    Partitions that the days had before and do not have any more are dropped after the write, so
    a failed run can simply be repeated.
    """
    days = sorted(set(days))
    if not days:
        return []
    folder = {d: f"{silver_path.rstrip('/')}/{DAY_KEY}={d}" for d in days}
    before = {d: _event_dates(spark, folder[d]) for d in days}
    raw = read_json_days(spark, feed_root, days, contracts.BRONZE[TABLE], layout=layout, landing_day=True)
    manifest.check_complete(spark, feed_root, raw, DAY_KEY, days)
    # (day, date) pairs of the loaded days, one for each folder that is written.
    now: dict[dt.date, set] = {d: set() for d in days}
    for r in raw.select(DAY_KEY, "date").distinct().collect():
        now[r[DAY_KEY]].add(r["date"])
    write_parquet_daily(distinct(raw), silver_path, (DAY_KEY, "date"))
    stale = {(d, x) for d in days for x in before[d] - now[d]}
    for d, x in stale:
        remove(spark, f"{folder[d]}/date={NULL_FOLDER if x is None else x}")
    return sorted({x for s in now.values() for x in s} | {x for _, x in stale}, key=lambda x: (x is None, x or dt.date.min))


def drop_emptied_days(spark: SparkSession, feed_root: str, silver_path: str) -> list[dt.date | None]:
    """Drop the silver days that the feed's manifest withdraws or declares complete without records;
    returns the event dates that may have changed.

    A day whose landing folder is merely gone (archived) keeps its rows. Only the manifest and the
    names of silver's days are read, not the landing folders.
    """
    there, touched = set(children(spark, silver_path)), set()
    for d in manifest.emptied(spark, feed_root):
        if (name := f"{DAY_KEY}={d}") in there:
            touched |= _event_dates(spark, f"{silver_path.rstrip('/')}/{name}")
            remove(spark, f"{silver_path.rstrip('/')}/{name}")
    return sorted(touched, key=lambda x: (x is None, x or dt.date.min))


def folder_dates(spark: SparkSession, silver_path: str) -> list[dt.date | None]:
    """The event dates that silver has, from the names of its folders (one listing for each landing day)."""
    days = [n for n in children(spark, silver_path) if n.startswith(f"{DAY_KEY}=")]
    found = {x for n in days for x in _event_dates(spark, f"{silver_path.rstrip('/')}/{n}")}
    return sorted(found, key=lambda x: (x is None, x or dt.date.min))


def read_landed(spark: SparkSession, silver_path: str) -> DataFrame:
    """All silver rows with their landing day."""
    return read_parquet(spark, silver_path, SCHEMA)


def read_events(spark: SparkSession, silver_path: str) -> DataFrame:
    """The distinct events (product_id, date), whatever days they were landed on."""
    return distinct(read_landed(spark, silver_path).select(*contracts.BRONZE[TABLE]))


def of_dates(events: DataFrame, dates: Iterable[dt.date | None]) -> DataFrame:
    """The events of the given dates; None stands for events without a date.

    The dates are literals (names of folders), so they reach the scan as a partition filter.
    """
    known = [d for d in dates if d is not None]
    some = F.col("date").isin(known) if known else F.lit(False)
    return events.where(some | F.col("date").isNull() if None in dates else some)
