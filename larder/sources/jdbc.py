"""S7 — relational snapshot over JDBC.

The extract reads a whole table in parallel, split on a number, date or timestamp column
into ``num_partitions`` ranges, so no single connection streams the table unless asked to. Bounds can be given
or computed by the database (one ``min/max`` query). The snapshot is published with
``larder.sinks.files.write_csv_snapshot``, whose output committer makes the dated folder
appear only when the whole table is written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..sinks.files import write_csv_snapshot

#: Connections of a split read unless the caller gives a number.
READ_CONNECTIONS = 8


def jdbc_options(url: str, properties: Mapping[str, str] | None = None, **extra: object) -> dict[str, str]:
    opts = {"url": url}
    opts.update({k: str(v) for k, v in (properties or {}).items()})
    opts.update({k: str(v) for k, v in extra.items() if v is not None})
    return opts


Bound = int | dt.date | dt.datetime


def _bound(value: object) -> Bound | None:
    """A bound as Spark's option takes it: dates and timestamps stay, other numbers become int."""
    return value if value is None or isinstance(value, dt.date) else int(value)  # type: ignore[call-overload]


def read_table_bounds(spark: SparkSession, url: str, table: str, column: str,
                      properties: Mapping[str, str] | None = None) -> tuple[Bound | None, Bound | None]:
    """Lower/upper bound of the split column, computed inside the database; None if it has no value."""
    bounds = (
        spark.read.format("jdbc")
        .options(**jdbc_options(url, properties,
                                query=f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"))
        .load()
        .first()
    )
    return _bound(bounds[0]), _bound(bounds[1])


def snapshot_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    *,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    bounds: tuple[Bound | None, Bound | None] = (None, None),
    single_connection: bool = False,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a snapshot read: ranges of ``partition_column``, or one connection on request."""
    if single_connection == bool(partition_column):
        raise ValueError("give a partition_column, or single_connection=True to stream the table through one task")
    opts = jdbc_options(url, properties, dbtable=table, fetchsize=fetch_size)
    if partition_column and None not in bounds:
        opts.update(partitionColumn=partition_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]),
                    numPartitions=str(num_partitions or READ_CONNECTIONS))
    return opts


def read_jdbc_snapshot(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    lower_bound: Bound | None = None,
    upper_bound: Bound | None = None,
    single_connection: bool = False,
    fetch_size: int = 10_000,
) -> DataFrame:
    """S7 — the table, in ranges of a number, date or timestamp column.

    A bound that is not given is asked of the database; a given one stays. Without a split
    column the caller must choose the single connection. An empty table is read in one go.
    """
    bounds = (lower_bound, upper_bound)
    if partition_column and None in bounds:
        found = read_table_bounds(spark, url, table, partition_column, properties)
        bounds = tuple(f if b is None else b for b, f in zip(bounds, found, strict=True))  # type: ignore[assignment]
    opts = snapshot_options(url, table, properties, partition_column=partition_column, num_partitions=num_partitions,
                            bounds=bounds, single_connection=single_connection, fetch_size=fetch_size)
    return spark.read.format("jdbc").options(**opts).load()


def extract_snapshot(spark: SparkSession, url: str, table: str, bronze_root: str, run_date: dt.date | str, **kw: object) -> str:
    """Extract stage: the table as it is now -> ``<bronze>/<date>/<table>`` CSV; returns the path."""
    return write_csv_snapshot(read_jdbc_snapshot(spark, url, table, **kw), bronze_root, run_date, table)  # type: ignore[arg-type]
