"""Stage functions of the daily runs (D1–D3, D8–D11) and the run entry points.

Every stage takes an explicit ``run_date``; there is no wall-clock date anywhere, so a
day can be re-run or back-filled. Each sink is one Spark action. Gold tables go to a
``GoldWriter``: Parquet under a root by default, or any callable (for example
``larder.sinks.jdbc.save_to_dwh`` bound to a warehouse URL).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts
from ..operators.registry import apply_transform
from ..quality.checks import conform, rejects_with_reason
from ..sessionconf import small_files_session
from ..sinks import files as sinks
from ..sinks import versions
from ..sources import files as src
from ..storage import children, exists, remove
from . import feed, marts

GoldWriter = Callable[[DataFrame, str], None]


@dataclass(frozen=True)
class ShopLayout:
    """Storage roots: CSV snapshots by date, JSON feed by date (how: ``SNAPSHOT_LAYOUTS`` and
    ``FEED_LAYOUTS``), ``silver/<table>`` Parquet, ``gold/<table>`` Parquet (when no warehouse
    writer)."""

    bronze: str
    feed: str
    silver: str
    gold: str
    snapshot_layout: str = "folder"
    feed_layout: str = "day"

    def silver_table(self, table: str) -> str:
        return f"{self.silver.rstrip('/')}/{table}"


def bronze_to_silver(
    spark: SparkSession,
    table: str,
    bronze_path: str,
    silver_path: str,
    *,
    rejects_date: dt.date | str | None = None,
    multiline: bool | None = None,
) -> None:
    """D1 (and D3 with ``rejects_date``): declared CSV read -> named transform -> Parquet.

    The silver table is fully overwritten (a snapshot), partitioned if its contract says
    so. Quoted line breaks are read where the contract (``MULTILINE``) or ``multiline`` says
    that the table has them. A value that does not fit its column is NULL in silver. With
    ``rejects_date`` every row that was not taken over as it was (malformed lines with the
    line, rows dropped by the NULL filter, surplus copies) is written with its reason as CSV
    under ``<silver>_errors/<date>/rejected.csv``.
    """
    multiline = table in contracts.MULTILINE if multiline is None else multiline
    spark = small_files_session(spark)
    read = lambda corrupt: src.read_csv(spark, bronze_path, contracts.BRONZE[table], multiline=multiline, corrupt_column=corrupt)
    clean = apply_transform(read(None), contracts.SILVER_TRANSFORM[table])
    sinks.write_parquet(clean, silver_path, mode="overwrite", partition_by=contracts.SILVER_PARTITION.get(table))
    if rejects_date is not None:
        rejects = rejects_with_reason(read(src.CORRUPT_COLUMN), contracts.TRANSFORM_REQUIRES.get(contracts.SILVER_TRANSFORM[table], ()),
                                      corrupt_column=src.CORRUPT_COLUMN)
        sinks.write_csv(rejects, sinks.rejects_path(silver_path, rejects_date))


def out_of_stock_to_silver(spark: SparkSession, layout: ShopLayout, run_dates: Iterable[dt.date]) -> list[dt.date | None]:
    """D2 (and S8 for several dates): landed JSON days -> silver, each landing day replaced whole.

    Returns the event dates (None: events without a date) whose facts may have changed.
    """
    return feed.load_days(small_files_session(spark), layout.feed, run_dates, layout.silver_table("out_of_stock"),
                          layout=layout.feed_layout)


def read_silver(spark: SparkSession, layout: ShopLayout, table: str) -> DataFrame:
    if table == feed.TABLE:
        return feed.read_events(spark, layout.silver_table(table))
    return src.read_parquet(spark, layout.silver_table(table), contracts.BRONZE[table])


def gold_path(spark: SparkSession, layout: ShopLayout, table: str) -> str:
    """Where a Parquet gold table lies; refuses a table that is stored in another layout."""
    path = f"{layout.gold.rstrip('/')}/{table}"
    partition = contracts.GOLD_PARTITION.get(table)
    stray = [n for n in children(spark, path) if (not n.startswith(f"{partition}=") if partition else "=" in n)]
    if stray:
        raise ValueError(f"{path} is not laid out as {table} is (partition column {partition}): it holds {stray[0]}")
    return path


def parquet_gold(layout: ShopLayout) -> GoldWriter:
    def write(df: DataFrame, table: str) -> None:
        sinks.write_parquet(df, gold_path(df.sparkSession, layout, table), partition_by=contracts.GOLD_PARTITION.get(table))
    return write


def build_gold(spark: SparkSession, layout: ShopLayout, write: GoldWriter | None = None,
               *, tables: Iterable[str] | None = None) -> None:
    """Silver -> gold: the configured dimension and fact refreshes (full overwrite each)."""
    write = write or parquet_gold(layout)
    spark = small_files_session(spark)
    s = lambda t: read_silver(spark, layout, t)
    builders: dict[str, Callable[[], DataFrame]] = {
        "dim_stores": lambda: marts.dim_stores(s("stores"), s("store_types")),
        "dim_products": lambda: marts.dim_products(s("products"), s("aisles"), s("departments")),
        "dim_clients": lambda: marts.dim_clients(s("clients")),
        "dim_area": lambda: marts.dim_area(s("location_areas")),
        "fact_orders": lambda: marts.fact_orders(s("orders")),
        "fact_out_of_stock": lambda: marts.fact_out_of_stock(s("out_of_stock")),
        "dim_date": lambda: marts.dim_date(s("orders"), s("out_of_stock")),
    }
    for table in tables or builders:
        write(conform(builders[table](), contracts.GOLD[table]), table)


def run_shop_snapshot(spark: SparkSession, layout: ShopLayout, run_date: dt.date,
                      write: GoldWriter | None = None, *, rejects: bool = False, parallel: int = 4) -> None:
    """Relational feed for one day: every bronze snapshot to silver, then the marts.

    The tables are independent, so up to ``parallel`` of them are loaded side by side.
    """
    def load(table: str) -> None:
        bronze_path = src.snapshot_path(layout.bronze, run_date, table, layout.snapshot_layout)
        bronze_to_silver(spark, table, bronze_path, layout.silver_table(table), rejects_date=run_date if rejects else None)

    tables = [t for t in contracts.SILVER_TRANSFORM if t != feed.TABLE]
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        list(pool.map(inheritable_thread_target(spark)(load), tables))
    for table in contracts.CALENDAR_DATES:
        keep_dates(spark, layout, table)
    build_gold(spark, layout, write,
               tables=["dim_stores", "dim_products", "dim_clients", "dim_area", "fact_orders"])


def touched_facts(spark: SparkSession, layout: ShopLayout, touched: Collection[dt.date | None]) -> DataFrame:
    """The facts of the touched event dates; silver's other date folders are not read."""
    events = feed.of_dates(read_silver(spark, layout, feed.TABLE), touched)
    return conform(marts.fact_out_of_stock(events), contracts.GOLD["fact_out_of_stock"])


def refresh_fact_out_of_stock(spark: SparkSession, layout: ShopLayout, touched: Collection[dt.date | None]) -> None:
    """D8 incremental on the Parquet gold layer: only the touched event dates are read from
    silver and replaced in gold, so a daily run costs its dates, not the whole history.

    A touched date without facts left loses its gold partition.
    """
    if not touched:
        return
    target = gold_path(spark, layout, "fact_out_of_stock")
    facts = touched_facts(spark, layout, touched)
    sinks.write_parquet(facts, target, mode="overwrite", partition_by=contracts.GOLD_PARTITION["fact_out_of_stock"], dynamic=True)
    left = {r[0] for r in facts.select("oos_date").distinct().collect()}  # touched dates alone, each a folder
    for date in set(touched) - left:
        remove(spark, f"{target}/oos_date={feed.NULL_FOLDER if date is None else date}")


def run_out_of_stock(spark: SparkSession, layout: ShopLayout, run_dates: Iterable[dt.date],
                     write: GoldWriter | None = None) -> None:
    """Out-of-stock feed for one or more days: landed JSON -> silver -> fact refresh.

    With the Parquet gold layer the fact refresh is incremental (the touched dates); a
    warehouse writer gets the full refresh (a JDBC write cannot replace single days).
    """
    spark = small_files_session(spark)
    touched = out_of_stock_to_silver(spark, layout, list(run_dates))
    if write is None:
        refresh_fact_out_of_stock(spark, layout, touched)
    else:
        build_gold(spark, layout, write, tables=["fact_out_of_stock"])


def dates_path(layout: ShopLayout, table: str) -> str:
    """Where the distinct dates of a silver table are kept beside it."""
    return f"{layout.silver_table(table)}_dates"


def keep_dates(spark: SparkSession, layout: ShopLayout, table: str) -> None:
    """Publish the distinct dates of the snapshot that was just loaded (one column is read).

    Done once for each snapshot, so no later run has to look for them in the table.
    """
    column = contracts.CALENDAR_DATES[table]
    dates = read_silver(spark, layout, table).select(F.col(column).alias("date")).distinct()
    versions.publish(dates.coalesce(1), dates_path(layout, table))
    versions.expire(spark, dates_path(layout, table))


def refresh_calendar(spark: SparkSession, layout: ShopLayout) -> None:
    """D10 as upkeep: the calendar from the kept dates of the snapshots and from the names of the
    feed's date folders. Neither orders nor events are read; equal to the full rebuild.
    """
    parts = [versions.read_published(spark, dates_path(layout, t), "date date") for t in contracts.CALENDAR_DATES]
    names = feed.folder_dates(spark, layout.silver_table(feed.TABLE))
    parts.append(spark.createDataFrame([(d,) for d in names], "date date"))
    dates = reduce(DataFrame.union, parts).select(F.col("date").alias(marts.DATE_COL)).distinct()
    target = gold_path(spark, layout, "dim_date")
    sinks.write_parquet(conform(marts.with_calendar_parts(dates).coalesce(1), contracts.GOLD["dim_date"]), target)


def append_calendar_day(spark: SparkSession, existing_dim_date: DataFrame, run_date: dt.date) -> DataFrame:
    """D11 — the calendar row to append for ``run_date`` (empty if already present)."""
    return conform(marts.append_dim_date(spark, existing_dim_date, run_date), contracts.GOLD["dim_date"])


def append_calendar(spark: SparkSession, layout: ShopLayout, run_date: dt.date, *,
                    append: GoldWriter | None = None, existing: DataFrame | None = None) -> None:
    """D11: append the run date's calendar row unless present.

    ``append`` takes the row and the table's name (for example ``append_to_dwh`` bound to a
    warehouse) and needs ``existing``, the calendar there; without both they are the Parquet
    gold layer's. A calendar that does not exist yet is empty; one that cannot be read is an error.
    """
    target = gold_path(spark, layout, "dim_date")
    if existing is None:
        if append is not None:
            raise ValueError("an append writer needs the calendar it appends to, or a key may be added twice")
        empty = not exists(spark, target)
        existing = spark.createDataFrame([], contracts.gold_schema("dim_date")) if empty else spark.read.parquet(target)
    row = append_calendar_day(spark, existing, run_date)
    if append is not None:
        append(row, "dim_date")
    else:
        sinks.write_parquet(row, target, mode="append")


def run_day(spark: SparkSession, layout: ShopLayout, run_date: dt.date, write: GoldWriter | None = None, *,
            append: GoldWriter | None = None, existing_calendar: DataFrame | None = None) -> None:
    """All feeds of one logical date: shop snapshot, out-of-stock day, calendar append.

    With a warehouse writer the calendar row goes to the warehouse too, so ``append`` and the
    warehouse's calendar (for keys that are there already) must be given.
    """
    if write is not None and (append is None or existing_calendar is None):
        raise ValueError("a warehouse run needs an append writer and the warehouse's calendar")
    run_shop_snapshot(spark, layout, run_date, write)
    run_out_of_stock(spark, layout, [run_date], write)
    append_calendar(spark, layout, run_date, append=append, existing=existing_calendar)
