"""The shop's bronze feeds, derived from the TPC-H-style test tables.

Role mapping: location areas = nation, store types = region, stores = supplier (store
type reached through the supplier's nation), clients = customer, products = part (aisle
= ``p_size``, department = the brand number), order lines = lineitem joined to orders,
out-of-stock events = returned line items (``l_returnflag = 'R'``) on their ship date.

The test tables hold no NULLs or duplicate rows, so each feed plants dirt the same way on
the Spark side and in the SQL side used by the independent check:
NULLs where ``key % 10 = 0``, an extra copy of every row where ``key % 7 = 0``; product
names with ``key % 11 = 0`` carry quotes and a comma (CSV dialect), client names with
``key % 13 = 0`` a line break. Every feed covers the whole source table. The landed feed
(``landed_out_of_stock``) lands the rows of every 13th product one day late and has no date
in those of every 17th; ``csv_lines`` are raw extracts with values that do not fit.

Keys are declared as 32-bit integers; a key beyond that fails the cast (ANSI mode).

``BRONZE_SQL`` holds the same definitions as SQL (DuckDB dialect) for the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import left_lookup

# Dirt-planting rules shared by the Spark and SQL definitions.
NULL_EVERY = 10
COPY_EVERY = 7
QUOTE_EVERY = 11
ORDER_NULL_STORE_EVERY = 100
QUOTED_SUFFIX = ' "promo", 1+1'
BREAK_EVERY = 13
BROKEN_LINE = "second line"
LATE_EVERY = 13
UNDATED_EVERY = 17
# Raw CSV lines of part p: what stands instead of a value where p % MISFIT_EVERY is the key.
MISFIT_EVERY = 97
MISFITS = {1: "n/a", 2: "3000000000", 3: "1.5"}
EXTRA_TOKEN_AT = 4


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _with_copies(df: DataFrame, key: Column) -> DataFrame:
    copies = F.when(key % COPY_EVERY == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("__copy", F.explode(copies)).drop("__copy")  # one pass over the source


def _int(c: str) -> Column:
    return F.col(c).cast("int")


def location_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = source(spark, sf_dir, "nation")
    df = n.select(F.col("n_nationkey").alias("area_id"), F.col("n_name").alias("area"))
    return _with_copies(df, F.col("area_id"))


def store_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = source(spark, sf_dir, "region")
    k = F.col("r_regionkey")
    df = r.select(k.alias("store_type_id"), _null_when(k % NULL_EVERY == 0, F.col("r_name")).alias("type"))
    return _with_copies(df, F.col("store_type_id"))


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = source(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = source(spark, sf_dir, "nation")
    joined = left_lookup(s, n, {"s_nationkey": "n_nationkey"}, {"n_regionkey": "n_regionkey"})
    k = F.col("s_suppkey")
    df = joined.select(
        _int("s_suppkey").alias("store_id"),
        F.col("s_nationkey").alias("location_area_id"),
        _null_when(k % NULL_EVERY == 0, F.col("n_regionkey")).alias("store_type_id"),
    )
    return _with_copies(df, F.col("store_id"))


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = source(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    df = c.select(
        _int("c_custkey").alias("id"),
        _null_when(k % NULL_EVERY == 0, F.when(k % BREAK_EVERY == 0, F.concat(F.col("c_name"), F.lit(f"\n{BROKEN_LINE}")))
                   .otherwise(F.col("c_name"))).alias("fullname"),
        F.col("c_nationkey").alias("location_area_id"),
    )
    return _with_copies(df, F.col("id"))


def _brand_number() -> Column:
    return F.substring_index(F.col("p_brand"), "#", -1).cast("int")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = source(spark, sf_dir, "part")
    k = F.col("p_partkey")
    name = F.when(k % QUOTE_EVERY == 0, F.concat(F.col("p_name"), F.lit(QUOTED_SUFFIX))).otherwise(F.col("p_name"))
    df = p.select(
        _int("p_partkey").alias("product_id"),
        name.alias("product_name"),
        F.col("p_size").alias("aisle_id"),
        _brand_number().alias("department_id"),
    )
    return _with_copies(df, F.col("product_id"))


def aisles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part: the extract repeats each aisle once per product on it."""
    p = source(spark, sf_dir, "part")
    size = F.col("p_size")
    label = F.concat(F.lit("Aisle "), size.cast("string"))
    return p.select(size.alias("aisle_id"), _null_when(size % NULL_EVERY == 0, label).alias("aisle"))


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part: the extract repeats each department once per product in it."""
    p = source(spark, sf_dir, "part")
    num = _brand_number()
    return p.select(num.alias("department_id"), _null_when(num % NULL_EVERY == 0, F.col("p_brand")).alias("department"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = source(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    o = source(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    k = F.col("l_orderkey")
    df = joined.select(
        _int("l_orderkey").alias("order_id"),
        _int("l_partkey").alias("product_id"),
        _int("o_custkey").alias("client_id"),
        _null_when(k % ORDER_NULL_STORE_EVERY == 0, _int("l_suppkey")).alias("store_id"),
        _int("l_quantity").alias("quantity"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )
    return _with_copies(df, F.col("order_id"))


def out_of_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = source(spark, sf_dir, "lineitem")
    return li.where(F.col("l_returnflag") == "R").select(
        _int("l_partkey").alias("product_id"),
        F.col("l_shipdate").cast("date").alias("date"),
    )


def landed_out_of_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The out-of-stock events with their landing ``day``: some late, some without a date."""
    li = source(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    k, shipped = F.col("l_partkey"), F.col("l_shipdate").cast("date")
    return li.select(
        _int("l_partkey").alias("product_id"),
        _null_when(k % UNDATED_EVERY == 0, shipped).alias("date"),
        F.date_add(shipped, F.when(k % LATE_EVERY == 0, 1).otherwise(0)).alias("day"),
    )


LANDED_SQL = (
    f"SELECT CAST(l_partkey AS INTEGER) AS product_id, CASE WHEN l_partkey % {UNDATED_EVERY} = 0 THEN NULL "
    "ELSE CAST(l_shipdate AS DATE) END AS date FROM lineitem WHERE l_returnflag = 'R'")


LANDED_DAYS_SQL = LANDED_SQL.replace(
    " FROM lineitem", f", CAST(l_shipdate AS DATE) + CASE WHEN l_partkey % {LATE_EVERY} = 0 THEN 1 ELSE 0 END AS day FROM lineitem")


def _misfit(key: Column, value: Column, only: tuple[int, ...]) -> Column:
    out = value.cast("string")
    for at in only:
        out = F.when(key % MISFIT_EVERY == at, F.lit(MISFITS[at])).otherwise(out)
    return out


def csv_lines(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Raw CSV lines (column ``line``) of the departments or products extract, one row for each
    part, with values that do not fit their column and lines with a value too many."""
    p = source(spark, sf_dir, "part")
    k = F.col("p_partkey")
    extra = F.when(k % MISFIT_EVERY == EXTRA_TOKEN_AT, F.lit(",extra")).otherwise(F.lit(""))
    text = lambda c: F.coalesce(c, F.lit(""))
    if table == "departments":
        num = _brand_number()
        name = _null_when(num % NULL_EVERY == 0, F.col("p_brand"))
        return p.select(F.concat(_misfit(k, num, (1, 2, 3)), F.lit(","), text(name), extra).alias("line"))
    name = F.when(k % QUOTE_EVERY == 0, F.concat(F.col("p_name"), F.lit(QUOTED_SUFFIX))).otherwise(F.col("p_name"))
    quoted = F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat(_int("p_partkey").cast("string"), F.lit(","), quoted, F.lit(","),
                    _misfit(k, F.col("p_size"), (1, 2)), F.lit(","), _misfit(k, _brand_number(), (3,)), extra)
    return _with_copies(p.select(line.alias("line"), "p_partkey"), k).select("line")


BRONZE: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "aisles": aisles,
    "clients": clients,
    "departments": departments,
    "products": products,
    "location_areas": location_areas,
    "store_types": store_types,
    "stores": stores,
    "orders": orders,
    "out_of_stock": out_of_stock,
}


def bronze(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return BRONZE[table](spark, sf_dir)


def _copies_sql(select: str, key: str) -> str:
    return f"({select}) UNION ALL (SELECT * FROM ({select}) WHERE {key} % {COPY_EVERY} = 0)"


_BRAND = "CAST(split_part(p_brand, '#', 2) AS INTEGER)"

BRONZE_SQL: dict[str, str] = {
    "location_areas": _copies_sql("SELECT n_nationkey AS area_id, n_name AS area FROM nation", "area_id"),
    "store_types": _copies_sql(
        f"SELECT r_regionkey AS store_type_id, CASE WHEN r_regionkey % {NULL_EVERY} = 0 THEN NULL "
        "ELSE r_name END AS type FROM region", "store_type_id"),
    "stores": _copies_sql(
        "SELECT CAST(s_suppkey AS INTEGER) AS store_id, s_nationkey AS location_area_id, "
        f"CASE WHEN s_suppkey % {NULL_EVERY} = 0 THEN NULL ELSE n_regionkey END AS store_type_id "
        "FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey", "store_id"),
    "clients": _copies_sql(
        "SELECT CAST(c_custkey AS INTEGER) AS id, "
        f"CASE WHEN c_custkey % {NULL_EVERY} = 0 THEN NULL WHEN c_custkey % {BREAK_EVERY} = 0 "
        f"THEN c_name || chr(10) || '{BROKEN_LINE}' ELSE c_name END AS fullname, "
        "c_nationkey AS location_area_id FROM customer", "id"),
    "products": _copies_sql(
        "SELECT CAST(p_partkey AS INTEGER) AS product_id, "
        f"CASE WHEN p_partkey % {QUOTE_EVERY} = 0 THEN p_name || '{QUOTED_SUFFIX}' ELSE p_name END AS product_name, "
        f"p_size AS aisle_id, {_BRAND} AS department_id FROM part", "product_id"),
    "aisles": (
        f"SELECT p_size AS aisle_id, CASE WHEN p_size % {NULL_EVERY} = 0 THEN NULL "
        "ELSE 'Aisle ' || CAST(p_size AS VARCHAR) END AS aisle FROM part"),
    "departments": (
        f"SELECT {_BRAND} AS department_id, CASE WHEN {_BRAND} % {NULL_EVERY} = 0 THEN NULL "
        "ELSE p_brand END AS department FROM part"),
    "orders": _copies_sql(
        "SELECT CAST(l_orderkey AS INTEGER) AS order_id, CAST(l_partkey AS INTEGER) AS product_id, "
        "CAST(o_custkey AS INTEGER) AS client_id, "
        f"CASE WHEN l_orderkey % {ORDER_NULL_STORE_EVERY} = 0 THEN NULL ELSE CAST(l_suppkey AS INTEGER) END AS store_id, "
        "CAST(l_quantity AS INTEGER) AS quantity, CAST(o_orderdate AS DATE) AS order_date "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey", "order_id"),
    "landed": LANDED_SQL,
    "landed_days": LANDED_DAYS_SQL,
    "out_of_stock": (
        "SELECT CAST(l_partkey AS INTEGER) AS product_id, CAST(l_shipdate AS DATE) AS date "
        "FROM lineitem WHERE l_returnflag = 'R'"),
}


def _misfit_sql(value: str, only: tuple[int, ...]) -> tuple[str, str]:
    """The value as it stands in the line, and as the declared type reads it."""
    cases = " ".join(f"WHEN {at} THEN '{MISFITS[at]}'" for at in only)
    raw = f"CASE p_partkey % {MISFIT_EVERY} {cases} ELSE CAST({value} AS VARCHAR) END"
    return raw, f"CASE WHEN p_partkey % {MISFIT_EVERY} IN ({', '.join(map(str, only))}) THEN NULL ELSE {value} END"


def csv_sql(table: str) -> str:
    """The extract of ``csv_lines`` in SQL: values as written (``r_<column>``) and as read,
    the line, and whether it is malformed."""
    extra = f"CASE WHEN p_partkey % {MISFIT_EVERY} = {EXTRA_TOKEN_AT} THEN ',extra' ELSE '' END"
    bad = f"p_partkey % {MISFIT_EVERY} IN ({', '.join(map(str, [*MISFITS, EXTRA_TOKEN_AT]))})"
    if table == "departments":
        raw, read = _misfit_sql(_BRAND, (1, 2, 3))
        name = f"CASE WHEN {_BRAND} % {NULL_EVERY} = 0 THEN NULL ELSE p_brand END"
        return (f"SELECT {raw} AS r_department_id, {read} AS department_id, {name} AS department, "
                f"{raw} || ',' || coalesce({name}, '') || {extra} AS line, {bad} AS bad FROM part")
    raw_a, aisle = _misfit_sql("p_size", (1, 2))
    raw_d, dept = _misfit_sql(_BRAND, (3,))
    name = f"CASE WHEN p_partkey % {QUOTE_EVERY} = 0 THEN p_name || '{QUOTED_SUFFIX}' ELSE p_name END"
    select = (f"SELECT CAST(p_partkey AS INTEGER) AS product_id, {name} AS product_name, {aisle} AS aisle_id, {dept} AS department_id, "
              f"p_partkey || ',\"' || replace({name}, '\"', '\"\"') || '\",' || {raw_a} || ',' || {raw_d} || {extra} AS line, {bad} AS bad FROM part")
    return _copies_sql(select, "product_id")


def with_bronze_sql(body: str, *tables: str) -> str:
    """Prefix ``body`` with the bronze feeds it uses as common table expressions."""
    ctes = ",\n".join(f"b_{t} AS ({BRONZE_SQL[t]})" for t in tables)
    return f"WITH {ctes}\n{body}" if tables else body
