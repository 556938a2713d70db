"""Calendar functions (F1–F6) and calendar tables (D10–D12 building blocks).

All parts are computed by built-in JVM expressions; the weekday name comes from the
``E`` pattern, which Spark formats in a fixed English locale regardless of the host.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Output column names of the calendar dimension.
DATE_COL = "action_date"
PART_COLS = ("action_day", "action_month", "action_year", "action_weekday")


def day_of_month(c: Column) -> Column:  # F1
    return F.dayofmonth(c)


def month_of(c: Column) -> Column:  # F2
    return F.month(c)


def year_of(c: Column) -> Column:  # F3
    return F.year(c)


def weekday_abbrev(c: Column) -> Column:  # F4 — 'Mon' .. 'Sun'
    return F.date_format(c, "E")


def calendar_parts(date_col: str = DATE_COL) -> list[Column]:
    c = F.col(date_col)
    return [
        F.col(date_col),
        day_of_month(c).alias("action_day"),
        month_of(c).alias("action_month"),
        year_of(c).alias("action_year"),
        weekday_abbrev(c).alias("action_weekday"),
    ]


def with_calendar_parts(dates: DataFrame, date_col: str = DATE_COL) -> DataFrame:
    """Calendar rows for a one-column DataFrame of dates."""
    return dates.select(*calendar_parts(date_col))


def calendar_row(spark: SparkSession, run_date: dt.date) -> DataFrame:
    """S6/F6 — the calendar row of one logical date, with a non-null date column."""
    schema = T.StructType([T.StructField(DATE_COL, T.DateType(), False)])
    return with_calendar_parts(spark.createDataFrame([(run_date,)], schema))


def calendar_between(start: Column, end: Column) -> Column:
    """Array of every date from ``start`` to ``end`` inclusive."""
    return F.sequence(start, end, F.expr("INTERVAL 1 DAY"))


def calendar_span(dates: DataFrame, date_col: str) -> DataFrame:
    """D12 — one calendar row per day between the earliest and latest date of ``dates``.

    The span is found with one global min/max aggregate (partial per task), then expanded;
    its size is the number of days covered, not the number of input rows.
    """
    bounds = dates.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    days = bounds.where(F.col("lo").isNotNull()).select(
        F.explode(calendar_between(F.col("lo"), F.col("hi"))).alias(DATE_COL)
    )
    return with_calendar_parts(days)


def calendar_range(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Calendar rows for a fixed date range (the warehouse seed)."""
    schema = T.StructType([T.StructField("lo", T.DateType(), False), T.StructField("hi", T.DateType(), False)])
    bounds = spark.createDataFrame([(start, end)], schema)
    return with_calendar_parts(bounds.select(F.explode(calendar_between(F.col("lo"), F.col("hi"))).alias(DATE_COL)))
