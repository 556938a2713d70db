"""K2/R2 — compaction of tables with a folder for each day into files near a target size.

A feed that lands thousands of small days leaves a file of some rows for each; reading them costs
per file, not per byte. ``compact`` packs consecutive dates into spans of about ``target_bytes``
by the sizes of their files, writes each span sorted by date, and publishes the result
(``versions``), so a reader sees the old version or the new one and a repeated run changes no
row. A date larger than the target is a span of its own, in several files.

A span's folder carries its first and last date, so a filter by date still prunes folders
(``between``), and the files' own statistics prune inside.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..contracts import Spec, to_struct
from ..sources.files import read_parquet
from . import versions

SPAN = "span"
TARGET_BYTES = 128 << 20
#: Span of the rows without a date.
NO_DATE = "none"


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the Parquet files under ``path``; the files are listed, not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
            .load(path).select("path", "length"))


def spans(spark: SparkSession, path: str, date_col: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """(date_col, span): consecutive dates of a table with folders ``<date_col>=<date>``, packed by file size.

    One row for each date: the only window without a key runs over them, not over the table's rows.
    """
    sizes = (file_sizes(spark, path).withColumn(date_col, F.to_date(F.nullif(F.regexp_extract("path", f"/{date_col}=(\\d{{4}}-\\d{{2}}-\\d{{2}})/", 1), F.lit(""))))
             .where(F.col(date_col).isNotNull()).groupBy(date_col).agg(F.sum("length").alias("bytes")))
    before = F.coalesce(F.sum("bytes").over(Window.orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    packed = sizes.withColumn("pack", F.floor(before / F.lit(target_bytes)))
    of_pack = Window.partitionBy("pack")
    name = F.concat_ws("_", F.min(date_col).over(of_pack).cast("string"), F.max(date_col).over(of_pack).cast("string"))
    return packed.select(date_col, name.alias(SPAN))


def compact(spark: SparkSession, path: str, out: str, schema: Spec, date_col: str, *, target_bytes: int = TARGET_BYTES) -> str:
    """Pack the daily table at ``path`` into a new published version of ``out``; returns its folder."""
    rows = read_parquet(spark, path, schema)
    packed = rows.join(F.broadcast(spans(spark, path, date_col, target_bytes)), date_col, "left")  # a row for each date
    packed = packed.select(*to_struct(schema).names, F.coalesce(SPAN, F.lit(NO_DATE)).alias(SPAN))
    # One shuffle deals whole spans out, and splits a span that is larger than a partition.
    return versions.publish(packed, out, partition_by=SPAN, sort_by=[date_col])


def read_compacted(spark: SparkSession, out: str, schema: Spec) -> DataFrame:
    """The rows of a compacted table with the column ``span``."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in to_struct(schema).fields)
    return versions.read_published(spark, out, f"{fields}, {SPAN} string")


def between(date_col: str, first: dt.date, last: dt.date) -> Column:
    """The rows of a compacted table with a date from ``first`` to ``last``; prunes spans."""
    return ((F.substring(SPAN, 1, 10) <= F.lit(str(last))) & (F.substring(SPAN, 12, 10) >= F.lit(str(first)))
            & F.col(date_col).between(F.lit(first), F.lit(last)))
