"""Table contracts: declared schemas for the bronze/silver inputs and the gold star schema.

A contract is written as an ordered mapping ``column -> {"type": ..., "nullable": ...}``
(the shape of the pipeline's YAML configuration) or as a Spark DDL string. ``to_struct``
turns either into a ``StructType``; the DDL form also covers decimal, array, map and
struct columns, which a bare type-class name cannot express.

Spark file sources do not enforce ``nullable=False``; ``larder.quality`` checks it as a
job instead (see ``required_columns``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

Spec = Mapping[str, Mapping[str, object]] | str | T.StructType


def _field(name: str, params: Mapping[str, object]) -> T.StructField:
    type_name = str(params["type"])
    data_type = getattr(T, type_name, None)
    if isinstance(data_type, type) and issubclass(data_type, T.DataType):
        spark_type = data_type()
    else:
        # Not a zero-argument type class: accept a DDL type such as ``decimal(12,2)``.
        spark_type = T._parse_datatype_string(type_name)
    return T.StructField(name, spark_type, bool(params.get("nullable", True)))


def to_struct(spec: Spec) -> T.StructType:
    """Declared schema (mapping, DDL string or StructType) -> ``StructType``."""
    if isinstance(spec, T.StructType):
        return spec
    if isinstance(spec, str):
        parsed = T._parse_datatype_string(spec)
        if not isinstance(parsed, T.StructType):
            raise ValueError(f"not a row schema: {spec!r}")
        return parsed
    return T.StructType([_field(name, params) for name, params in spec.items()])


def required_columns(spec: Spec) -> list[str]:
    return [f.name for f in to_struct(spec).fields if not f.nullable]


def _cols(*pairs: tuple[str, str, bool]) -> dict[str, dict[str, object]]:
    return {name: {"type": type_name, "nullable": nullable} for name, type_name, nullable in pairs}


INT, STR, DATE = "IntegerType", "StringType", "DateType"

# The declared bronze/silver schemas of the shop feeds (column order matters,
# CSV columns bind by position).
BRONZE: dict[str, dict[str, dict[str, object]]] = {
    "aisles": _cols(("aisle_id", INT, False), ("aisle", STR, True)),
    "clients": _cols(("id", INT, False), ("fullname", STR, True), ("location_area_id", INT, True)),
    "departments": _cols(("department_id", INT, False), ("department", STR, True)),
    "products": _cols(
        ("product_id", INT, False), ("product_name", STR, True),
        ("aisle_id", INT, True), ("department_id", INT, True),
    ),
    "location_areas": _cols(("area_id", INT, False), ("area", STR, True)),
    "store_types": _cols(("store_type_id", INT, False), ("type", STR, True)),
    "stores": _cols(("store_id", INT, False), ("location_area_id", INT, True), ("store_type_id", INT, True)),
    "orders": _cols(
        ("order_id", INT, True), ("product_id", INT, True), ("client_id", INT, True),
        ("store_id", INT, True), ("quantity", INT, True), ("order_date", DATE, True),
    ),
    "out_of_stock": _cols(("product_id", INT, False), ("date", DATE, False)),
}

# Silver layout — transform name per table and the Hive partition column.
SILVER_TRANSFORM = {
    "aisles": "transform_aisles",
    "clients": "transform_common",
    "departments": "transform_departments",
    "products": "transform_common",
    "location_areas": "transform_common",
    "store_types": "transform_types",
    "stores": "transform_common",
    "orders": "transform_common",
    "out_of_stock": "transform_common",
}
# Columns a named transform requires: rows without them are dropped before de-duplication.
TRANSFORM_REQUIRES: dict[str, tuple[str, ...]] = {
    "transform_common": (),
    "transform_aisles": ("aisle",),
    "transform_departments": ("department",),
    "transform_types": ("type",),
}
SILVER_PARTITION: dict[str, str | tuple[str, ...]] = {"orders": "store_id", "out_of_stock": ("day", "date")}

# Snapshot tables whose dates belong in the calendar, and the column (the feed's are folder names).
CALENDAR_DATES = {"orders": "order_date"}

# Tables whose CSV extracts hold quoted line breaks (such files cannot be split).
MULTILINE = frozenset({"clients"})

# Partition columns of gold tables; every writer of a Parquet gold layer follows them.
GOLD_PARTITION = {"fact_out_of_stock": "oos_date"}

# The gold star schema (column order, types, NOT NULL, varchar limits, keys).
# dim_products.product_name is a string (the source column is text).
GOLD: dict[str, dict[str, dict[str, object]]] = {
    "dim_date": _cols(
        ("action_date", DATE, False), ("action_day", INT, False), ("action_month", INT, False),
        ("action_year", INT, False), ("action_weekday", STR, False),
    ),
    "dim_products": _cols(
        ("product_id", INT, False), ("product_name", STR, True),
        ("department_name", STR, True), ("aisle", STR, True),
    ),
    "dim_area": _cols(("area_id", INT, False), ("area", STR, True)),
    "dim_clients": _cols(("client_id", INT, False), ("fullname", STR, True), ("area_id", INT, True)),
    "dim_stores": _cols(("store_id", INT, False), ("area_id", INT, True), ("type", STR, True)),
    "fact_orders": _cols(
        ("product_id", INT, False), ("client_id", INT, False), ("store_id", INT, False),
        ("order_date", DATE, False), ("quantity", INT, True),
    ),
    "fact_out_of_stock": _cols(("product_id", INT, False), ("oos_date", DATE, False)),
}
GOLD_KEYS: dict[str, tuple[str, ...]] = {
    "dim_date": ("action_date",),
    "dim_products": ("product_id",),
    "dim_area": ("area_id",),
    "dim_clients": ("client_id",),
    "dim_stores": ("store_id",),
    "fact_orders": ("product_id", "client_id", "store_id", "order_date"),
    "fact_out_of_stock": ("product_id", "oos_date"),
}
GOLD_MAX_LENGTH: dict[str, dict[str, int]] = {
    "dim_date": {"action_weekday": 3},
    "dim_products": {"department_name": 127, "aisle": 127},
    "dim_area": {"area": 64},
    "dim_clients": {"fullname": 64},
    "dim_stores": {"type": 64},
}


def bronze_schema(table: str) -> T.StructType:
    return to_struct(BRONZE[table])


def gold_schema(table: str) -> T.StructType:
    return to_struct(GOLD[table])
