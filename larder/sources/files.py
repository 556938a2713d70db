"""File scans: bronze CSV snapshots, daily JSON feeds, silver Parquet tables.

All readers take the declared contract instead of inferring, except ``read_csv_inferred``
(the second, schemaless read the reject log compares against).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import Spec, to_struct

CORRUPT_COLUMN = "_corrupt_record"

# The bronze CSV dialect. Relational extracts double embedded quotes
# (``"a ""b"" c"``), so the escape character is the quote itself.
CSV_DIALECT = {"header": "true", "quote": '"', "escape": '"'}

# Column and directory key of the landing day of a daily JSON feed.
DAY_KEY = "day"

# Where one logical day of a JSON feed, and one table of a daily snapshot, lie.
FEED_LAYOUTS = {"day": "{root}/day={date}", "dated": "{root}/{date}/data.json"}
SNAPSHOT_LAYOUTS = {"folder": "{root}/{date}/{table}", "file": "{root}/{date}/{table}.csv"}


def day_dir(root: str, run_date: dt.date | str, layout: str = "day") -> str:
    return FEED_LAYOUTS[layout].format(root=root.rstrip("/"), date=run_date)


def snapshot_path(root: str, run_date: dt.date | str, table: str, layout: str = "folder") -> str:
    return SNAPSHOT_LAYOUTS[layout].format(root=root.rstrip("/"), date=run_date, table=table)


def day_pattern(layout: str = "day") -> str:
    """A pattern whose first group is the landing day in a landed file's path."""
    return FEED_LAYOUTS[layout].format(root="", date=r"(\d{4}-\d{2}-\d{2})").replace(".", "[.]") + "/?"


def with_landing_day(df: DataFrame, layout: str = "day") -> DataFrame:
    """``df`` with the landing day of each record, taken from its file's path."""
    return df.withColumn(DAY_KEY, F.to_date(F.regexp_extract(F.col("_metadata.file_path"), day_pattern(layout), 1)))


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: Spec,
    *,
    multiline: bool = False,
    corrupt_column: str | None = None,
    check_header: bool = True,
) -> DataFrame:
    """S1/S1b — CSV with header, bound to the declared schema.

    ``check_header`` makes Spark compare the header with the declared names and fail on a
    mismatch instead of binding swapped columns by position. ``multiline`` is needed only
    when quoted values hold line breaks; it makes each file a single split, so it is off by
    default. ``corrupt_column`` keeps the raw text of rows that did not fit the schema.
    """
    struct = to_struct(schema)
    if corrupt_column:
        struct = T.StructType(struct.fields + [T.StructField(corrupt_column, T.StringType(), True)])
    reader = (
        spark.read.options(**CSV_DIALECT)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", "false" if check_header else "true")
        .option("multiLine", "true" if multiline else "false")
        .schema(struct)
    )
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.csv(path)


def read_csv_inferred(spark: SparkSession, path: str | list[str], *, multiline: bool = False) -> DataFrame:
    """S2 — CSV with header and inferred types (an extra pass over all rows of the input)."""
    return (
        spark.read.options(**CSV_DIALECT)
        .option("inferSchema", "true")
        .option("multiLine", "true" if multiline else "false")
        .csv(path)
    )


def read_json_day(spark: SparkSession, root: str, run_date: dt.date | str, schema: Spec, *, layout: str = "day") -> DataFrame:
    """S3 — one logical day of a landed JSON feed, with the declared types applied."""
    return spark.read.schema(to_struct(schema)).json(day_dir(root, run_date, layout))


def read_json_days(spark: SparkSession, root: str, run_dates: Iterable[dt.date | str], schema: Spec, *,
                   layout: str = "day", landing_day: bool = False) -> DataFrame:
    """S8 — several logical days in one scan (a backfill). A missing day fails the read.

    ``landing_day`` adds the column ``day`` with the day each record was landed on, whatever
    dates the records themselves carry.
    """
    struct = to_struct(schema)
    paths = [day_dir(root, d, layout) for d in run_dates]
    if not paths:
        empty = T.StructType(struct.fields + [T.StructField(DAY_KEY, T.DateType())]) if landing_day else struct
        return spark.createDataFrame([], empty)
    df = spark.read.schema(struct).json(paths)
    return with_landing_day(df, layout) if landing_day else df


def read_parquet(spark: SparkSession, path: str, schema: Spec | None = None) -> DataFrame:
    """S4/S5 — silver Parquet table, Hive partitions discovered.

    With a contract, partition columns get the declared type and the declared column order
    is restored (discovery appends partition columns at the end).
    """
    if schema is None:
        return spark.read.parquet(path)
    struct = to_struct(schema)
    return spark.read.schema(struct).parquet(path).select(*[F.col(f"`{f.name}`") for f in struct.fields])
