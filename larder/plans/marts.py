"""Star-schema marts (D4–D11): pure ``DataFrame -> DataFrame`` functions over silver tables.

No I/O happens here; ``larder.plans.daily`` reads silver and writes gold.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import DATE_COL, calendar_row, with_calendar_parts
from ..operators.joins import left_lookup
from ..operators.keys import new_keys_only
from ..operators.partitioning import cluster_by
from ..operators.relational import distinct, identity, rename, select_as
from ..operators.setops import union_distinct

PRODUCT_COLS = ("product_id", "product_name", "department_name", "aisle")


def dim_products(products: DataFrame, aisles: DataFrame, departments: DataFrame) -> DataFrame:
    """D4 — products with their aisle and department names (two lookups)."""
    with_aisle = left_lookup(products, aisles, {"aisle_id": "aisle_id"}, {"aisle": "aisle"})
    with_dept = left_lookup(with_aisle, departments, {"department_id": "department_id"},
                            {"department": "department_name"})
    return with_dept.select(*PRODUCT_COLS)


def dim_clients(clients: DataFrame) -> DataFrame:
    """D5 — clients with warehouse column names."""
    return rename(clients, {"id": "client_id", "location_area_id": "area_id"})


def dim_area(location_areas: DataFrame) -> DataFrame:
    """D6 — location areas as they are."""
    return identity(location_areas)


def dim_stores(stores: DataFrame, store_types: DataFrame) -> DataFrame:
    """D7 — stores with their area and store-type name."""
    joined = left_lookup(stores, store_types, {"store_type_id": "store_type_id"}, {"type": "type"})
    return select_as(joined, {"store_id": "store_id", "area_id": "location_area_id", "type": "type"})


def fact_out_of_stock(out_of_stock: DataFrame, run_date: dt.date | None = None) -> DataFrame:
    """D8 — out-of-stock facts; with ``run_date`` only that day (partition pruned)."""
    df = out_of_stock if run_date is None else out_of_stock.where(F.col("date") == F.lit(run_date))
    return rename(df.select("product_id", "date"), {"date": "oos_date"})


ORDER_FACT_COLS = ("product_id", "client_id", "store_id", "order_date", "quantity")


def fact_orders(orders: DataFrame, *, cluster: bool = True, num_partitions: int | None = None) -> DataFrame:
    """D9 — order facts (order id dropped), clustered by store for the write."""
    facts = select_as(orders, ORDER_FACT_COLS)
    return cluster_by(facts, "store_id", num_partitions=num_partitions) if cluster else facts


def action_dates(orders: DataFrame, out_of_stock: DataFrame) -> DataFrame:
    """Every distinct date on which something happened (orders or out-of-stock)."""
    # Distinct on each side first: the planner then drops a whole-row distinct below it.
    return union_distinct(
        distinct(orders.select(F.col("order_date").alias(DATE_COL))),
        distinct(out_of_stock.select(F.col("date").alias(DATE_COL))),
    )


def dim_date(orders: DataFrame, out_of_stock: DataFrame, *, drop_null_dates: bool = False) -> DataFrame:
    """D10 — full rebuild of the calendar dimension from the dates in the facts.

    A NULL date yields one all-NULL row unless ``drop_null_dates``.
    """
    dates = action_dates(orders, out_of_stock)
    if drop_null_dates:
        dates = dates.where(F.col(DATE_COL).isNotNull())
    return with_calendar_parts(dates)


def append_dim_date(spark: SparkSession, existing: DataFrame, run_date: dt.date) -> DataFrame:
    """D11 — the calendar row of ``run_date`` if ``existing`` does not hold it yet."""
    return new_keys_only(calendar_row(spark, run_date), existing, [DATE_COL])
