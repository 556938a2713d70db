"""File sinks: silver Parquet, reject CSV, dated CSV snapshots and JSON landing.

Partitioned writes are clustered first with a ``rebalance`` hint on the partition
columns: each output directory is then written by few tasks (no file per task per
value), and adaptive execution splits a directory that holds a large share of the rows
(one busy store or day) into several tasks instead of one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import manifest
from ..sources.files import CSV_DIALECT, DAY_KEY, day_dir, snapshot_path
from ..storage import children, move, plain_local_files, scratch_path


def _cols(partition_by: str | Sequence[str] | None) -> list[str]:
    if partition_by is None:
        return []
    return [partition_by] if isinstance(partition_by, str) else list(partition_by)


def _clustered(df: DataFrame, partition_cols: list[str]) -> DataFrame:
    return df.hint("rebalance", *partition_cols) if partition_cols else df


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by: str | Sequence[str] | None = None,
    dynamic: bool = False,
    max_records_per_file: int | None = None,
    sort_by: Sequence[str] = (),
) -> None:
    """K1 (overwrite), K2 (append) and K2b (``dynamic=True``).

    Static overwrite replaces the whole directory. Dynamic overwrite replaces only the
    partitions present in ``df``, so re-running a day rewrites that day and nothing else
    (a plain append would store the day twice).
    """
    cols = _cols(partition_by)
    clustered = _clustered(df, cols)
    if sort_by:  # inside each file, so its statistics prune
        clustered = clustered.sortWithinPartitions(*cols, *sort_by)
    writer = clustered.write.mode(mode)
    if cols:
        writer = writer.partitionBy(*cols).options(**plain_local_files(df.sparkSession))
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.parquet(path)


def write_parquet_daily(df: DataFrame, path: str, partition_by: str | Sequence[str] = "date") -> None:
    """K2b — re-runnable daily write: overwrite exactly the days present in ``df``."""
    write_parquet(df, path, mode="overwrite", partition_by=partition_by, dynamic=True)


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """K3 — CSV with header in the bronze dialect (reject sets, snapshots)."""
    df.write.mode(mode).options(**CSV_DIALECT).csv(path)


def rejects_path(silver_path: str, run_date: dt.date | str) -> str:
    return f"{silver_path.rstrip('/')}_errors/{run_date}/rejected.csv"


def write_csv_snapshot(df: DataFrame, bronze_root: str, run_date: dt.date | str, table: str) -> str:
    """S7 publish step — ``<bronze>/<date>/<table>`` appears only once fully written."""
    path = snapshot_path(bronze_root, run_date, table)
    write_csv(df, path)
    return path


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """R1 — a catalog table in a fixed number of hash buckets of ``key``, instead of a folder a key.

    The number of files follows the buckets, however many keys there are, and tables with the same
    key and buckets join without an exchange. The rows are clustered by ``rebalance``, so a key that
    holds a large share of them is written by several tasks (several files of its bucket).
    """
    at = next(c for c in ("bucket", "bucket_", "bucket__") if c not in df.columns)
    clustered = df.withColumn(at, F.pmod(F.hash(key), F.lit(buckets))).hint("rebalance", at).drop(at)  # the bucket as Spark counts it
    (clustered.write.mode("overwrite").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def land_json_day(df: DataFrame, root: str, run_date: dt.date | str, *, layout: str = "day", declared: bool = True) -> None:
    """K6 — land one day's feed in its day's folder (overwrites that day).

    The day is then declared complete in the feed's manifest, with its number of records.
    """
    spark, path = df.sparkSession, day_dir(root, run_date, layout)
    df.write.mode("overwrite").json(path)
    if declared:
        landed = spark.read.schema(df.schema).json(path).count()  # what is there, not what a second run of ``df`` gives
        manifest.declare(spark, root, {run_date: landed})


def land_json_days(df: DataFrame, root: str, date_col: str = "date", *, layout: str = "day") -> None:
    """K6 for many days at once: one folder per value of ``date_col``.

    Records keep their own date field (a column named ``day`` is the landing day alone and
    is not written into the records); only the days present are replaced. The ``dated`` layout
    is written beside and its days are put in place one after another.
    """
    landed = df.withColumn(DAY_KEY, F.col(date_col))
    target = root if layout == "day" else scratch_path(df.sparkSession, "land_json_days")
    (_clustered(landed, [DAY_KEY]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(DAY_KEY).json(target))
    if layout != "day":
        for name in children(df.sparkSession, target):
            move(df.sparkSession, f"{target}/{name}", day_dir(root, name.partition("=")[2], layout))
