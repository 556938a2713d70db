"""Named queries over the test tables: one per operator/flow of the pipeline.

Every entry has a Spark builder ``(spark, sf_dir) -> DataFrame`` and, where the result is
expressible in SQL, the same result as DuckDB SQL over the raw test tables (the
independent check). Builders that round-trip through files write under the shared
folder (``larder.storage``), a fresh directory per run.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts
from ..functions import calendar as cal
from ..operators import keys, setops
from ..operators import relational as rel
from ..operators.keys import new_keys_only
from ..operators.partitioning import cluster_by
from ..operators.registry import apply_transform
from ..quality import checks
from ..sessionconf import small_files_session
from ..sinks import compaction, versions
from ..sinks import files as sinks
from ..sources import drift, manifest
from ..sources import files as src
from ..storage import remove, scratch_path
from . import daily, feed, marts, roles
from .roles import with_bronze_sql as W

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def register(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


def bronze(spark: SparkSession, d: str, table: str) -> DataFrame:
    return roles.bronze(spark, d, table)


def silver(spark: SparkSession, d: str, table: str) -> DataFrame:
    return apply_transform(bronze(spark, d, table), contracts.SILVER_TRANSFORM[table])


# SQL of the silver transforms (drop-NULL where configured, then DISTINCT).
def silver_sql(table: str) -> str:
    required = contracts.TRANSFORM_REQUIRES[contracts.SILVER_TRANSFORM[table]]
    where = " WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in required) if required else ""
    return f"SELECT DISTINCT * FROM b_{table}{where}"


def WS(body: str, *tables: str) -> str:
    """SQL over silver tables ``s_<table>`` (and their bronze feeds ``b_<table>``)."""
    ctes = [f"b_{t} AS ({roles.BRONZE_SQL[t]})" for t in tables]
    ctes += [f"s_{t} AS ({silver_sql(t)})" for t in tables]
    return "WITH " + ",\n".join(ctes) + "\n" + body


CAL_SQL = (
    "action_date, CAST(day(action_date) AS INTEGER) AS action_day, "
    "CAST(month(action_date) AS INTEGER) AS action_month, "
    "CAST(year(action_date) AS INTEGER) AS action_year, "
    "strftime(action_date, '%a') AS action_weekday"
)

# --------------------------------------------------------------------------- marts


@query("dim_stores", WS(
    "SELECT s.store_id, s.location_area_id AS area_id, t.type FROM s_stores s "
    "LEFT JOIN s_store_types t ON t.store_type_id = s.store_type_id", "stores", "store_types"))
def q_dim_stores(spark, d):
    return marts.dim_stores(silver(spark, d, "stores"), silver(spark, d, "store_types"))


@query("dim_products", WS(
    "SELECT p.product_id, p.product_name, dp.department AS department_name, a.aisle FROM s_products p "
    "LEFT JOIN s_aisles a ON a.aisle_id = p.aisle_id "
    "LEFT JOIN s_departments dp ON dp.department_id = p.department_id",
    "products", "aisles", "departments"))
def q_dim_products(spark, d):
    return marts.dim_products(silver(spark, d, "products"), silver(spark, d, "aisles"),
                              silver(spark, d, "departments"))


@query("dim_clients", WS(
    "SELECT id AS client_id, fullname, location_area_id AS area_id FROM s_clients", "clients"))
def q_dim_clients(spark, d):
    return marts.dim_clients(silver(spark, d, "clients"))


@query("dim_area", WS("SELECT area_id, area FROM s_location_areas", "location_areas"))
def q_dim_area(spark, d):
    return marts.dim_area(silver(spark, d, "location_areas"))


_FACT_ORDERS_SQL = WS("SELECT product_id, client_id, store_id, order_date, quantity FROM s_orders", "orders")


@query("fact_orders", _FACT_ORDERS_SQL)
def q_fact_orders(spark, d):
    return marts.fact_orders(silver(spark, d, "orders"))


@query("repartition_key", _FACT_ORDERS_SQL)
def q_repartition_key(spark, d):
    """R1 with a fixed partition count (for example one per warehouse connection)."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return marts.fact_orders(silver(spark, d, "orders"), num_partitions=tasks)


@query("fact_out_of_stock", WS("SELECT product_id, date AS oos_date FROM s_out_of_stock", "out_of_stock"))
def q_fact_out_of_stock(spark, d):
    return marts.fact_out_of_stock(silver(spark, d, "out_of_stock"))


@query("dim_date", WS(
    f"SELECT {CAL_SQL} FROM (SELECT order_date AS action_date FROM s_orders "
    "UNION SELECT date FROM s_out_of_stock) u", "orders", "out_of_stock"))
def q_dim_date(spark, d):
    return marts.dim_date(silver(spark, d, "orders"), silver(spark, d, "out_of_stock"))


@query("calendar_range", W(
    f"SELECT {CAL_SQL} FROM (SELECT CAST(unnest(generate_series(CAST(min(order_date) AS TIMESTAMP), "
    "CAST(max(order_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS action_date FROM b_orders) g", "orders"))
def q_calendar_range(spark, d):
    """D12 — every day between the first and the last order date."""
    return cal.calendar_span(bronze(spark, d, "orders"), "order_date")


@query("calendar_one_day", W(
    f"SELECT {CAL_SQL} FROM (SELECT max(date) AS action_date FROM b_out_of_stock) m", "out_of_stock"))
def q_calendar_one_day(spark, d):
    """D11/S6 — the calendar row of the latest out-of-stock day (the feed's run date)."""
    run_date = bronze(spark, d, "out_of_stock").agg(F.max("date")).first()[0]
    return cal.calendar_row(spark, run_date)


@query("append_new_keys", W(
    f"SELECT {CAL_SQL} FROM (SELECT DISTINCT date AS action_date FROM b_landed "
    "EXCEPT SELECT CASE WHEN month(order_date) = 2 THEN NULL ELSE order_date END FROM b_orders) n",
    "landed", "orders"))
def q_append_new_keys(spark, d):
    """K5b — calendar rows of out-of-stock days that the order calendar does not hold yet: keys
    repeat in the new rows, and both sides have rows without a date."""
    order_date = F.when(F.month("order_date") != 2, F.col("order_date"))
    existing = cal.with_calendar_parts(bronze(spark, d, "orders").select(order_date.alias(cal.DATE_COL)))
    new = cal.with_calendar_parts(roles.landed_out_of_stock(spark, d).select(F.col("date").alias(cal.DATE_COL)))
    return new_keys_only(new, existing, [cal.DATE_COL])


# ------------------------------------------------------------ set operations, projections


_DATES_ALL = "SELECT order_date AS action_date FROM b_orders UNION ALL SELECT date FROM b_out_of_stock"


def _order_dates(spark, d):
    return bronze(spark, d, "orders").select(F.col("order_date").alias(cal.DATE_COL))


def _oos_dates(spark, d):
    return bronze(spark, d, "out_of_stock").select(F.col("date").alias(cal.DATE_COL))


@query("union_all", W(_DATES_ALL, "orders", "out_of_stock"))
def q_union_all(spark, d):
    return setops.union_all(_order_dates(spark, d), _oos_dates(spark, d))


@query("union_distinct", W(_DATES_ALL.replace("UNION ALL", "UNION"), "orders", "out_of_stock"))
def q_union_distinct(spark, d):
    return setops.union_distinct(_order_dates(spark, d), _oos_dates(spark, d))


@query("distinct_dates", W("SELECT DISTINCT order_date AS action_date FROM b_orders", "orders"))
def q_distinct_dates(spark, d):
    return rel.distinct(_order_dates(spark, d))


@query("project_alias", W(
    "SELECT store_id, location_area_id AS area_id, store_type_id AS type_id FROM b_stores", "stores"))
def q_project_alias(spark, d):
    return rel.select_as(bronze(spark, d, "stores"),
                         {"store_id": "store_id", "area_id": "location_area_id", "type_id": "store_type_id"})


@query("rename_columns", W(
    "SELECT id AS client_id, fullname AS client_name, location_area_id AS area_id FROM b_clients", "clients"))
def q_rename_columns(spark, d):
    return rel.rename(bronze(spark, d, "clients"),
                      {"id": "client_id", "fullname": "client_name", "location_area_id": "area_id"})


@query("filter_not_null", W("SELECT * FROM b_departments WHERE department IS NOT NULL", "departments"))
def q_filter_not_null(spark, d):
    return rel.not_null(bronze(spark, d, "departments"), "department")


@query("dedup_rows", W("SELECT DISTINCT * FROM b_clients", "clients"))
def q_dedup_rows(spark, d):
    return rel.dedup_rows(bronze(spark, d, "clients"))


def _silver_query(table: str) -> None:
    @query(f"silver_{table}", W(silver_sql(table), table))
    def q(spark, d):
        return silver(spark, d, table)


for _t in contracts.BRONZE:
    _silver_query(_t)

# ------------------------------------------------------------------ sources and sinks


def _land_bronze_csv(spark, d, table: str, name: str) -> str:
    path = scratch_path(spark, name)
    sinks.write_csv_snapshot(bronze(spark, d, table), path, "run", table)
    return sinks.snapshot_path(path, "run", table)


@query("scan_csv_declared", W("SELECT * FROM b_products", "products"))
def q_scan_csv_declared(spark, d):
    """S1 — bronze CSV (quoted names with commas and quotes) read with the declared schema."""
    path = _land_bronze_csv(spark, d, "products", "scan_csv_declared")
    return src.read_csv(spark, path, contracts.BRONZE["products"])


_BAD = "n/a"


@query("scan_csv_corrupt", W(
    "SELECT store_id, CASE WHEN store_id % 10 = 5 THEN NULL ELSE location_area_id END AS location_area_id, "
    "store_type_id, CASE WHEN store_id % 10 = 5 THEN CAST(store_id AS VARCHAR) || ',n/a,' || "
    "coalesce(CAST(store_type_id AS VARCHAR), '') END AS _corrupt_record FROM b_stores", "stores"))
def q_scan_csv_corrupt(spark, d):
    """S1b — malformed values become NULL and the raw line is kept in ``_corrupt_record``."""
    stores = bronze(spark, d, "stores")
    text = stores.select(
        F.col("store_id").cast("string").alias("store_id"),
        F.when(F.col("store_id") % 10 == 5, F.lit(_BAD))
        .otherwise(F.col("location_area_id").cast("string")).alias("location_area_id"),
        F.col("store_type_id").cast("string").alias("store_type_id"),
    )
    path = scratch_path(spark, "scan_csv_corrupt")
    sinks.write_csv(text, path)
    return src.read_csv(spark, path, contracts.BRONZE["stores"], corrupt_column=src.CORRUPT_COLUMN)


@query("scan_csv_inferred", W("SELECT * FROM b_orders", "orders"))
def q_scan_csv_inferred(spark, d):
    """S2 — the schemaless read: ints infer as int, ISO dates as date."""
    path = _land_bronze_csv(spark, d, "orders", "scan_csv_inferred")
    return src.read_csv_inferred(spark, path)


def _land_feed(spark, d, name: str) -> str:
    root = scratch_path(spark, name)
    sinks.land_json_days(bronze(small_files_session(spark), d, "out_of_stock"), root)
    return root


def _feed_days(spark, d) -> list:
    """Logical dates present in the feed (one value per day, not per row)."""
    days = bronze(spark, d, "out_of_stock").select("date").distinct().orderBy("date")
    return [r[0] for r in days.collect()]


@query("land_json_daily", W("SELECT * FROM b_out_of_stock", "out_of_stock"))
def q_land_json_daily(spark, d):
    """K6 — land every day, then land the latest day again on its own (a daily re-run):
    the re-landed day replaces, never duplicates, what was there."""
    root = _land_feed(spark, d, "land_json_daily")
    feed = bronze(spark, d, "out_of_stock")
    run_date = feed.agg(F.max("date")).first()[0]
    sinks.land_json_day(feed.where(F.col("date") == F.lit(run_date)), root, run_date)
    return spark.read.schema(contracts.to_struct(contracts.BRONZE["out_of_stock"])).json(root) \
        .select("product_id", "date")


@query("scan_json_daily", W(
    "SELECT * FROM b_out_of_stock WHERE date = (SELECT max(date) FROM b_out_of_stock)", "out_of_stock"))
def q_scan_json_daily(spark, d):
    """S3 — one logical day (the latest) of a feed landed as ``<root>/<date>/data.json``; the
    day before lies beside it."""
    root = scratch_path(spark, "scan_json_daily")
    events = bronze(spark, d, "out_of_stock")
    run_date = events.agg(F.max("date")).first()[0]
    for back in (1, 0):
        day = run_date - dt.timedelta(days=back)
        sinks.land_json_day(events.where(F.col("date") == F.lit(day)), root, day, layout="dated")
    return src.read_json_day(spark, root, run_date, contracts.BRONZE["out_of_stock"], layout="dated")


@query("backfill_dates", W("SELECT * FROM b_out_of_stock", "out_of_stock"))
def q_backfill_dates(spark, d):
    """S8 — all days of the feed in one scan, by an explicit list of run dates."""
    root = _land_feed(spark, d, "backfill_dates")
    return src.read_json_days(spark, root, _feed_days(spark, d), contracts.BRONZE["out_of_stock"])


@query("silver_out_of_stock_daily", WS("SELECT * FROM s_out_of_stock", "out_of_stock"))
def q_silver_out_of_stock_daily(spark, d):
    """D2 — landed JSON -> silver Parquet by landing day and event date -> distinct events."""
    spark = small_files_session(spark)
    root = _land_feed(spark, d, "silver_out_of_stock_daily")
    out = scratch_path(spark, "silver_out_of_stock_daily_silver")
    feed.load_days(spark, root, _feed_days(spark, d), out)
    return feed.read_events(spark, out)


@query("stream_out_of_stock", WS("SELECT * FROM s_out_of_stock", "out_of_stock"))
def q_stream_out_of_stock(spark, d):
    """D2 as an availableNow file stream over the landed days."""
    from ..streaming.feed import run_feed_to_silver

    spark = small_files_session(spark)
    out = scratch_path(spark, "stream_out_of_stock")
    run_feed_to_silver(spark, _land_feed(spark, d, "stream_out_of_stock"), f"{out}/silver", f"{out}/checkpoint")
    return feed.read_events(spark, f"{out}/silver")


_EVENTS_SQL = W("SELECT DISTINCT product_id, date FROM b_landed", "landed")


def _days_of(events: DataFrame) -> list:
    return sorted(r[0] for r in events.select("day").distinct().collect())  # landing days, not rows


@query("oos_late_rows", _EVENTS_SQL)
def q_oos_late_rows(spark, d):
    """D2 with late rows and rows without a date: odd landing days, then even ones, then the odd
    ones once more; no run takes away what another brought."""
    spark = small_files_session(spark)
    root, out = scratch_path(spark, "oos_late_rows_feed"), scratch_path(spark, "oos_late_rows")
    events = roles.landed_out_of_stock(spark, d)
    sinks.land_json_days(events, root, "day")
    days = _days_of(events)
    for parity in (1, 0, 1):
        feed.load_days(spark, root, [x for x in days if x.toordinal() % 2 == parity], out)
    return feed.read_events(spark, out)


@query("oos_late_rows_stream", _EVENTS_SQL)
def q_oos_late_rows_stream(spark, d):
    """The same feed through the stream: odd days are landed and run, then even ones, and the
    run is repeated."""
    from ..streaming.feed import run_feed_to_silver

    spark = small_files_session(spark)
    root, out = scratch_path(spark, "oos_late_rows_stream_feed"), scratch_path(spark, "oos_late_rows_stream")
    events = roles.landed_out_of_stock(spark, d)
    odd = F.pmod(F.unix_date("day"), F.lit(2)) == 0  # every other day, as date ordinals are odd and even
    for part in (events.where(odd), events.where(~odd), None):
        if part is not None:
            sinks.land_json_days(part, root, "day")
        run_feed_to_silver(spark, root, f"{out}/silver", f"{out}/checkpoint")
    return feed.read_events(spark, f"{out}/silver")


@query("fact_oos_full_then_daily", W("SELECT DISTINCT product_id, date AS oos_date FROM b_landed", "landed"))
def q_fact_oos_full_then_daily(spark, d):
    """D8 — a full build of the fact, then the refresh of the latest landing day: both write one
    layout, so the fact is whole, rows without a date included."""
    spark = small_files_session(spark)
    base = scratch_path(spark, "fact_oos_full_then_daily")
    layout = daily.ShopLayout(f"{base}/bronze", f"{base}/feed", f"{base}/silver", f"{base}/gold")
    events = roles.landed_out_of_stock(spark, d)
    sinks.write_parquet_daily(rel.distinct(events), layout.silver_table("out_of_stock"), ("day", "date"))
    daily.build_gold(spark, layout, tables=["fact_out_of_stock"])
    run_date = events.agg(F.max("day")).first()[0]
    sinks.land_json_days(events.where(F.col("day") == F.lit(run_date)), layout.feed, "day")
    daily.run_out_of_stock(spark, layout, [run_date])
    return src.read_parquet(spark, f"{layout.gold}/fact_out_of_stock", contracts.GOLD["fact_out_of_stock"])


@query("stream_dated_layout", _EVENTS_SQL)
def q_stream_dated_layout(spark, d):
    """D2/S3 — the stream over ``<date>/data.json``: half of the days are landed and run, then the
    others; then some early days are archived, and the run after that takes nothing away."""
    from ..streaming.feed import run_feed_to_silver

    spark = small_files_session(spark)
    root, out = scratch_path(spark, "stream_dated_layout_feed"), scratch_path(spark, "stream_dated_layout")
    events = roles.landed_out_of_stock(spark, d)
    odd = F.pmod(F.unix_date("day"), F.lit(2)) == 0
    for part in (events.where(odd), events.where(~odd)):
        sinks.land_json_days(part, root, "day", layout="dated")
        run_feed_to_silver(spark, root, f"{out}/silver", f"{out}/checkpoint", layout="dated")
    first = events.agg(F.min("day")).first()[0]
    remove(spark, f"{root}/{first}")
    run_feed_to_silver(spark, root, f"{out}/silver", f"{out}/checkpoint", layout="dated")
    return feed.read_events(spark, f"{out}/silver")


@query("feed_withdrawn_days", W(
    "SELECT DISTINCT product_id, date FROM b_landed_days WHERE day <> (SELECT max(day) FROM b_landed_days) "
    "AND day <> (SELECT min(day) FROM b_landed_days)", "landed_days"))
def q_feed_withdrawn_days(spark, d):
    """D2 — the manifest: the last landing day is withdrawn, the first is landed again without a
    record; both leave silver, all other days stay though no landing folder is left."""
    spark = small_files_session(spark)
    root, out = scratch_path(spark, "feed_withdrawn_days_feed"), scratch_path(spark, "feed_withdrawn_days")
    events = roles.landed_out_of_stock(spark, d)
    sinks.land_json_days(events, root, "day")
    days = _days_of(events)
    manifest.declare(spark, root, {r["day"]: r["count"] for r in events.groupBy("day").count().collect()})
    feed.load_days(spark, root, days, out)
    for day in days:
        remove(spark, src.day_dir(root, day))
    manifest.withdraw(spark, root, [days[-1]])
    manifest.declare(spark, root, {days[0]: 0})
    feed.drop_emptied_days(spark, root, out)
    return feed.read_events(spark, out)


@query("sink_parquet_published", WS("SELECT * FROM s_clients", "clients"))
def q_sink_parquet_published(spark, d):
    """K1 — published versions: the second is written from the rows of the first, which then goes."""
    path = scratch_path(spark, "sink_parquet_published")
    versions.publish(silver(spark, d, "clients"), path)
    versions.publish(versions.read_published(spark, path, contracts.BRONZE["clients"]), path)
    versions.expire(spark, path)
    return versions.read_published(spark, path, contracts.BRONZE["clients"])


@query("compact_daily_table", WS("SELECT * FROM s_out_of_stock", "out_of_stock"))
def q_compact_daily_table(spark, d):
    """K2/R2 — a table with a folder for each day, packed into spans near a target size, twice."""
    spark = small_files_session(spark)
    daily_path, out = scratch_path(spark, "compact_daily_table_days"), scratch_path(spark, "compact_daily_table")
    sinks.write_parquet_daily(silver(spark, d, "out_of_stock"), daily_path)
    for _ in range(2):
        compaction.compact(spark, daily_path, out, contracts.BRONZE["out_of_stock"], "date", target_bytes=1 << 20)
    return compaction.read_compacted(spark, out, contracts.BRONZE["out_of_stock"]).drop(compaction.SPAN)


@query("append_new_keys_bucketed", W(
    "SELECT DISTINCT order_date AS action_date FROM b_orders WHERE order_date > (SELECT max(order_date) - 400 FROM b_orders)", "orders"))
def q_append_new_keys_bucketed(spark, d):
    """K5b — the dates before the last 400 days are in the key table; all dates are appended twice, and
    only those of the last 400 days are new, the second time none."""
    path = scratch_path(spark, "append_new_keys_bucketed")
    dates = bronze(spark, d, "orders").select(F.col("order_date").alias("action_date"))
    last = dates.agg(F.max("action_date")).first()[0]
    keys.add_keys(dates.where(F.col("action_date") <= F.lit(last - dt.timedelta(days=400))).distinct(), path, ["action_date"], buckets=64)
    out = scratch_path(spark, "append_new_keys_bucketed_rows")
    for _ in range(2):
        new = keys.new_keys_bucketed(dates, path, ["action_date"], buckets=64)
        sinks.write_parquet(new, out, mode="append")
        keys.add_keys(src.read_parquet(spark, out), path, ["action_date"], buckets=64)
    return src.read_parquet(spark, out)


@query("dim_date_upkeep", WS(
    f"SELECT {CAL_SQL} FROM (SELECT order_date AS action_date FROM s_orders "
    "UNION SELECT date FROM s_out_of_stock) u", "orders", "out_of_stock"))
def q_dim_date_upkeep(spark, d):
    """D10 — the calendar from kept dates and folder names; orders and events are not read for it."""
    spark = small_files_session(spark)
    base = scratch_path(spark, "dim_date_upkeep")
    layout = daily.ShopLayout(f"{base}/bronze", f"{base}/feed", f"{base}/silver", f"{base}/gold")
    sinks.write_parquet(silver(spark, d, "orders"), layout.silver_table("orders"), partition_by="store_id")
    daily.keep_dates(spark, layout, "orders")
    events = silver(spark, d, "out_of_stock").withColumn("day", F.col("date"))
    sinks.write_parquet_daily(events, layout.silver_table("out_of_stock"), ("day", "date"))
    daily.refresh_calendar(spark, layout)
    return src.read_parquet(spark, f"{layout.gold}/dim_date", contracts.GOLD["dim_date"])


def _land_drifting_products(spark, d, name: str) -> list[str]:
    """Products as three daily files: as the contract has them; with two columns changed round and one
    more; without one column."""
    base, rows = scratch_path(spark, name), bronze(spark, d, "products")
    part = F.pmod(F.coalesce("product_id", F.lit(0)), F.lit(3))
    variants = [rows.where(part == 0),
                rows.where(part == 1).select("product_id", "aisle_id", F.lit("x,y").alias("note"), "product_name", "department_id"),
                rows.where(part == 2).select("product_id", "product_name", "aisle_id")]
    return [sinks.write_csv_snapshot(v, base, f"2021-01-0{k}", "products") for k, v in enumerate(variants, 1)]


_THIRD = "coalesce(product_id, 0) % 3"


@query("scan_csv_drift", W(
    f"SELECT product_id, product_name, aisle_id, CASE WHEN {_THIRD} <> 2 THEN department_id END AS department_id FROM b_products", "products"))
def q_scan_csv_drift(spark, d):
    """X2/S2 — daily files whose headers differ, bound by name."""
    return drift.read_csv_by_name(spark, _land_drifting_products(spark, d, "scan_csv_drift"), contracts.BRONZE["products"])


@query("schema_drift_report", W(
    "SELECT * FROM (VALUES ('2021-01-02', 'note', 'added'), ('2021-01-02', 'aisle_id', 'moved'), ('2021-01-02', 'product_name', 'moved'), "
    "('2021-01-03', 'department_id', 'missing')) t(day, \"column\", change) WHERE (SELECT count(*) FROM b_products) > 0", "products"))
def q_schema_drift_report(spark, d):
    """X2/S2 — what changed in which day's files."""
    paths = _land_drifting_products(spark, d, "schema_drift_report")
    report = drift.drift_report(spark, paths, contracts.BRONZE["products"])
    return report.select(F.regexp_extract("file", r"/(\d{4}-\d{2}-\d{2})/", 1).alias("day"), "column", "change").distinct()


@query("fact_orders_bucketed", WS(
    "SELECT f.store_id, st.location_area_id AS area_id, count(*) AS n_orders, CAST(sum(f.quantity) AS BIGINT) AS quantity FROM s_orders f "
    "JOIN s_stores st ON st.store_id = f.store_id GROUP BY ALL", "orders", "stores"))
def q_fact_orders_bucketed(spark, d):
    """R1 — facts and stores in the same hash buckets of the store: they join, and sum up by store,
    without an exchange."""
    base, tag = scratch_path(spark, "fact_orders_bucketed"), uuid.uuid4().hex[:12]
    facts = marts.fact_orders(silver(spark, d, "orders"), cluster=False)
    for name, df in (("facts", facts), ("stores", marts.dim_stores(silver(spark, d, "stores"), silver(spark, d, "store_types")))):
        sinks.write_bucketed(df, f"larder_{name}_{tag}", f"{base}/{name}", "store_id", 16)
    joined = spark.table(f"larder_facts_{tag}").join(spark.table(f"larder_stores_{tag}").hint("merge"), "store_id")
    return joined.groupBy("store_id", "area_id").agg(F.count("*").alias("n_orders"), F.sum("quantity").alias("quantity"))


def _write_twice(df: DataFrame, name: str, **kw) -> str:
    out = scratch_path(df.sparkSession, name)
    sinks.write_parquet(df, out, **kw)
    sinks.write_parquet(df, out, **kw)
    return out


@query("sink_parquet_overwrite", WS("SELECT * FROM s_clients", "clients"))
def q_sink_parquet_overwrite(spark, d):
    """K1 — overwrite twice: the table holds one copy."""
    out = _write_twice(silver(small_files_session(spark), d, "clients"), "sink_parquet_overwrite", mode="overwrite")
    return src.read_parquet(spark, out, contracts.BRONZE["clients"])


@query("sink_parquet_append", WS(
    "SELECT * FROM s_out_of_stock UNION ALL SELECT * FROM s_out_of_stock", "out_of_stock"))
def q_sink_parquet_append(spark, d):
    """K2 — append partitioned by date twice: every row is stored twice (plain append)."""
    out = _write_twice(silver(small_files_session(spark), d, "out_of_stock"), "sink_parquet_append",
                       mode="append", partition_by="date")
    return src.read_parquet(spark, out, contracts.BRONZE["out_of_stock"])


@query("sink_daily_idempotent", WS("SELECT * FROM s_out_of_stock", "out_of_stock"))
def q_sink_daily_idempotent(spark, d):
    """K2b — dynamic partition overwrite twice: re-running the days does not duplicate."""
    out = _write_twice(silver(small_files_session(spark), d, "out_of_stock"), "sink_daily_idempotent",
                       mode="overwrite", partition_by="date", dynamic=True)
    return src.read_parquet(spark, out, contracts.BRONZE["out_of_stock"])


@query("scan_parquet", WS("SELECT * FROM s_products", "products"))
def q_scan_parquet(spark, d):
    """S4 — silver table by path."""
    out = scratch_path(spark, "scan_parquet")
    sinks.write_parquet(silver(spark, d, "products"), out)
    return src.read_parquet(spark, out)


@query("scan_partitioned", WS("SELECT * FROM s_orders", "orders"))
def q_scan_partitioned(spark, d):
    """S5 — Hive-partitioned silver orders: ``store_id`` typed from the directory names,
    NULL stores read back from the default partition, column moved to the end."""
    spark = small_files_session(spark)
    out = scratch_path(spark, "scan_partitioned")
    sinks.write_parquet(silver(spark, d, "orders"), out, partition_by="store_id")
    return src.read_parquet(spark, out)


def _bronze_to_silver(spark, d, table: str) -> DataFrame:
    """D1: CSV snapshot -> declared read -> registry transform -> Parquet (partitioned if the
    contract says so) -> silver read in declared column order."""
    spark = small_files_session(spark)
    path = _land_bronze_csv(spark, d, table, f"bronze_to_silver_{table}")
    out = scratch_path(spark, f"bronze_to_silver_{table}_silver")
    daily.bronze_to_silver(spark, table, path, out)
    return src.read_parquet(spark, out, contracts.BRONZE[table])


@query("bronze_to_silver", WS("SELECT * FROM s_orders", "orders"))
def q_bronze_to_silver(spark, d):
    """D1 for orders, partitioned by store."""
    return _bronze_to_silver(spark, d, "orders")


def _bronze_to_silver_query(table: str) -> None:
    @query(f"bronze_to_silver_{table}", WS(f"SELECT * FROM s_{table}", table))
    def q(spark, d):
        return _bronze_to_silver(spark, d, table)


for _t in contracts.BRONZE:
    if _t != feed.TABLE:
        _bronze_to_silver_query(_t)


def _land_csv_lines(spark, d, table: str, name: str) -> str:
    """A raw extract with values that do not fit: its lines as they are, under the header."""
    path = scratch_path(spark, name)
    header = ",".join(contracts.BRONZE[table])
    lines = roles.csv_lines(spark, d, table).select(F.col("line").alias(header))
    (lines.write.options(header="true", sep="\u0001", quote="\u0002", escape="\u0002",
                         ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path))
    return path


_DIRTY = {t: f"WITH raw AS ({roles.csv_sql(t)}) " for t in ("departments", "products")}


@query("rejects_diff", _DIRTY["departments"] + (
    "SELECT r_department_id AS department_id, department FROM raw EXCEPT ALL "
    "SELECT DISTINCT CAST(department_id AS VARCHAR), department FROM raw WHERE department IS NOT NULL"))
def q_rejects_diff(spark, d):
    """U3/D3 — raw (inferred) departments minus silver: values that do not fit, as they stand in
    the extract, NULL names and surplus copies."""
    path = _land_csv_lines(spark, d, "departments", "rejects_diff")
    raw = src.read_csv_inferred(spark, path)
    clean = apply_transform(src.read_csv(spark, path, contracts.BRONZE["departments"]), "transform_departments")
    return checks.rejected_rows(raw, clean)


def _reasoned_sql(table: str, null_column: str | None) -> str:
    cols = ", ".join(contracts.BRONZE[table])
    null = f"{null_column} IS NULL" if null_column else "false"
    parts = [f"SELECT {cols}, line AS raw_line, 'malformed' AS reason FROM raw WHERE bad"]
    if null_column:
        parts.append(f"SELECT {cols}, CAST(NULL AS VARCHAR), 'null:{null_column}' FROM raw WHERE NOT bad AND {null}")
    parts.append(f"SELECT {cols}, CAST(NULL AS VARCHAR), 'duplicate' FROM (SELECT {cols}, unnest(range(n - 1)) FROM "
                 f"(SELECT {cols}, count(*) AS n FROM raw WHERE NOT bad AND NOT ({null}) GROUP BY {cols}))")
    return _DIRTY[table] + " UNION ALL ".join(parts)


@query("rejects_reasoned", _reasoned_sql("departments", "department"))
def q_rejects_reasoned(spark, d):
    """D3 with reasons, from one scan: malformed lines, NULL names and surplus copies."""
    path = _land_csv_lines(spark, d, "departments", "rejects_reasoned")
    raw = src.read_csv(spark, path, contracts.BRONZE["departments"], corrupt_column=src.CORRUPT_COLUMN)
    return checks.rejects_with_reason(raw, ["department"], corrupt_column=src.CORRUPT_COLUMN)


@query("sink_csv_rejects", _reasoned_sql("products", None))
def q_sink_csv_rejects(spark, d):
    """K3/D3 — the products reject log written as CSV under ``<silver>_errors/<date>`` and read back."""
    path = _land_csv_lines(spark, d, "products", "sink_csv_rejects")
    out = f"{scratch_path(spark, 'sink_csv_rejects_silver')}/products"
    daily.bronze_to_silver(spark, "products", path, out, rejects_date="run")
    schema = {**contracts.BRONZE["products"], checks.RAW_LINE_COLUMN: {"type": contracts.STR}, checks.REASON_COLUMN: {"type": contracts.STR}}
    return src.read_csv(spark, sinks.rejects_path(out, "run"), schema)


# ----------------------------------------------------------------------- quality checks


@query("check_unique_key", WS(
    "SELECT order_id, count(*) AS n FROM s_orders GROUP BY order_id HAVING count(*) > 1", "orders"))
def q_check_unique_key(spark, d):
    """V1 — order ids shared by several silver order lines."""
    return checks.duplicate_keys(silver(spark, d, "orders"), ["order_id"])


_FACT_COLS = list(marts.ORDER_FACT_COLS)


@query("check_not_null", WS(
    "SELECT count(*) AS rows, "
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS nulls_{c}" for c in _FACT_COLS)
    + " FROM s_orders", "orders"))
def q_check_not_null(spark, d):
    """V2 — NULLs in the NOT NULL columns of fact_orders (one pass)."""
    return checks.null_counts(marts.fact_orders(silver(spark, d, "orders"), cluster=False), _FACT_COLS)


def _length_sql(table: str, source_sql: str) -> str:
    parts = []
    for c, limit in contracts.GOLD_MAX_LENGTH[table].items():
        parts.append(
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, {limit} AS max_allowed, "
            f"CAST(max(length({c})) AS INTEGER) AS max_length, "
            f"count(*) FILTER (WHERE length({c}) > {limit}) AS violations FROM ({source_sql}) x"
        )
    return " UNION ALL ".join(parts)


_DIM_SQL = {
    "dim_products": "SELECT p.product_id, p.product_name, dp.department AS department_name, a.aisle "
                    "FROM s_products p LEFT JOIN s_aisles a ON a.aisle_id = p.aisle_id "
                    "LEFT JOIN s_departments dp ON dp.department_id = p.department_id",
    "dim_area": "SELECT area_id, area FROM s_location_areas",
    "dim_clients": "SELECT id AS client_id, fullname, location_area_id AS area_id FROM s_clients",
    "dim_stores": "SELECT s.store_id, s.location_area_id AS area_id, t.type FROM s_stores s "
                  "LEFT JOIN s_store_types t ON t.store_type_id = s.store_type_id",
    "dim_date": f"SELECT {CAL_SQL} FROM (SELECT order_date AS action_date FROM s_orders "
                "UNION SELECT date FROM s_out_of_stock) u",
}
_ALL_SILVER = tuple(contracts.BRONZE)


@query("check_max_length", WS(
    " UNION ALL ".join(_length_sql(t, _DIM_SQL[t]) for t in contracts.GOLD_MAX_LENGTH), *_ALL_SILVER))
def q_check_max_length(spark, d):
    """V3 — longest value and violations of every varchar limit of the gold dimensions."""
    dims = {
        "dim_date": q_dim_date(spark, d),
        "dim_products": q_dim_products(spark, d),
        "dim_area": q_dim_area(spark, d),
        "dim_clients": q_dim_clients(spark, d),
        "dim_stores": q_dim_stores(spark, d),
    }
    out = None
    for table, limits in contracts.GOLD_MAX_LENGTH.items():
        part = checks.length_violations(dims[table], limits, table)
        out = part if out is None else out.unionByName(part)
    return out


@query("conform_schema", (
    "SELECT CAST(l_partkey AS INTEGER) AS product_id, CAST(o_custkey AS INTEGER) AS client_id, "
    "CAST(l_suppkey AS INTEGER) AS store_id, CAST(o_orderdate AS DATE) AS order_date, "
    "CAST(l_quantity AS INTEGER) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey"))
def q_conform_schema(spark, d):
    """V4 — source-typed order lines (bigint keys, double quantity, timestamps) cast to the
    fact_orders contract: its columns, order and types."""
    li = roles.source(spark, d, "lineitem")
    o = roles.source(spark, d, "orders")
    lines = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_partkey").alias("product_id"), F.col("o_custkey").alias("client_id"),
        F.col("l_suppkey").alias("store_id"), F.col("o_orderdate").alias("order_date"),
        F.col("l_quantity").alias("quantity"),
    )
    return checks.conform(lines, contracts.GOLD["fact_orders"])


_GOLD_SQL = dict(_DIM_SQL)
_GOLD_SQL["fact_orders"] = "SELECT product_id, client_id, store_id, order_date, quantity FROM s_orders"
_GOLD_SQL["fact_out_of_stock"] = "SELECT product_id, date AS oos_date FROM s_out_of_stock"


def _report_sql(table: str) -> str:
    struct = contracts.gold_schema(table)
    src_sql = _GOLD_SQL[table]
    parts = [
        f"SELECT '{table}' AS table_name, 'not_null' AS check_name, '{f.name}' AS subject, "
        f"count(*) FILTER (WHERE {f.name} IS NULL) AS violations FROM ({src_sql}) x"
        for f in struct.fields if not f.nullable
    ]
    parts += [
        f"SELECT '{table}' AS table_name, 'max_length_{n}' AS check_name, '{c}' AS subject, "
        f"count(*) FILTER (WHERE length({c}) > {n}) AS violations FROM ({src_sql}) x"
        for c, n in contracts.GOLD_MAX_LENGTH.get(table, {}).items()
    ]
    keys = contracts.GOLD_KEYS[table]
    parts.append(
        f"SELECT '{table}' AS table_name, 'unique_key' AS check_name, '{','.join(keys)}' AS subject, "
        f"count(*) AS violations FROM (SELECT {', '.join(keys)} FROM ({src_sql}) x "
        f"GROUP BY {', '.join(keys)} HAVING count(*) > 1) d"
    )
    return " UNION ALL ".join(parts)


@query("check_gold_contracts", WS(" UNION ALL ".join(_report_sql(t) for t in contracts.GOLD), *_ALL_SILVER))
def q_check_gold_contracts(spark, d):
    """V1–V3 for all seven gold tables built from the silver feeds: NULLs in NOT NULL
    columns, over-length values and duplicated primary keys, one row per check."""
    gold = {
        "dim_date": q_dim_date(spark, d),
        "dim_products": q_dim_products(spark, d),
        "dim_area": q_dim_area(spark, d),
        "dim_clients": q_dim_clients(spark, d),
        "dim_stores": q_dim_stores(spark, d),
        "fact_orders": marts.fact_orders(silver(spark, d, "orders"), cluster=False),
        "fact_out_of_stock": q_fact_out_of_stock(spark, d),
    }
    out = None
    for table, df in gold.items():
        part = checks.contract_report(df, table, contracts.GOLD[table], contracts.GOLD_KEYS[table],
                                      contracts.GOLD_MAX_LENGTH.get(table))
        out = part if out is None else out.unionByName(part)
    return out


@query("fact_out_of_stock_day", WS(
    "SELECT product_id, date AS oos_date FROM s_out_of_stock "
    "WHERE date = (SELECT max(date) FROM s_out_of_stock)", "out_of_stock"))
def q_fact_out_of_stock_day(spark, d):
    """D8 incremental — the fact rows of one event date (the latest) from silver by landing day
    and event date: the date filter prunes to that date's folders."""
    spark = small_files_session(spark)
    out = scratch_path(spark, "fact_out_of_stock_day")
    events = silver(spark, d, "out_of_stock").withColumn("day", F.col("date"))
    sinks.write_parquet_daily(events, out, ("day", "date"))
    run_date = events.agg(F.max("date")).first()[0]
    return marts.fact_out_of_stock(feed.read_events(spark, out), run_date=run_date)
