"""K4/K5 — warehouse writes over JDBC.

``overwrite`` truncates instead of dropping, so primary keys and grants declared in the
warehouse DDL survive. ``num_partitions`` caps concurrent connections (Spark coalesces
to it before writing). A retried task may write rows of a part that its first attempt had
committed, so keyed tables should be loaded into a staging table that the warehouse swaps
in or merges from. Re-running an append on keyed tables should go through
``larder.operators.keys.new_keys_only`` first.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..sources.jdbc import jdbc_options

# Warehouse write settings.
OVERWRITE_BATCH_SIZE = 100_000
QUERY_TIMEOUT_SECONDS = 690

#: Concurrent connections of a write unless the caller gives a number.
WRITE_CONNECTIONS = 8


def warehouse_write_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    *,
    mode: str,
    batch_size: int | None = None,
    truncate: bool = True,
    num_partitions: int | None = None,
    query_timeout: int | None = QUERY_TIMEOUT_SECONDS,
) -> dict[str, str]:
    extra: dict[str, object] = {"dbtable": table}
    if batch_size:
        extra["batchsize"] = batch_size
    if mode == "overwrite" and truncate:
        extra["truncate"] = "true"
    extra["numPartitions"] = num_partitions or WRITE_CONNECTIONS
    if query_timeout:
        extra["queryTimeout"] = query_timeout
    return jdbc_options(url, properties, **extra)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    *,
    mode: str = "overwrite",
    batch_size: int | None = OVERWRITE_BATCH_SIZE,
    truncate: bool = True,
    num_partitions: int | None = None,
) -> None:
    opts = warehouse_write_options(url, table, properties, mode=mode, batch_size=batch_size,
                                   truncate=truncate, num_partitions=num_partitions)
    df.write.format("jdbc").options(**opts).mode(mode).save()


def save_to_dwh(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
                **kw: object) -> None:
    """K4 — full refresh of a warehouse table."""
    write_jdbc(df, url, table, properties, mode="overwrite", **kw)  # type: ignore[arg-type]


def append_to_dwh(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
                  **kw: object) -> None:
    """K5 — append rows to a warehouse table."""
    kw.setdefault("batch_size", None)
    write_jdbc(df, url, table, properties, mode="append", **kw)  # type: ignore[arg-type]
