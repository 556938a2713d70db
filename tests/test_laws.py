"""Laws from the test strategy, over every bronze feed of the smallest test tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from larder import contracts
from larder.operators import joins, relational as rel
from larder.plans import daily, roles
from larder.quality import checks
from larder.sinks import files as sinks
from larder.sources import files as src
from tests.conftest import SF_SMOKE

SNAPSHOT_TABLES = [t for t in contracts.BRONZE if t != "out_of_stock"]


@pytest.mark.parametrize("table", SNAPSHOT_TABLES)
def test_raw_equals_silver_plus_rejects(spark, out, table):
    sinks.write_csv_snapshot(roles.bronze(spark, SF_SMOKE, table), out, "d", table)
    bronze_path = src.snapshot_path(out, "d", table)
    silver_path = f"{out}/silver/{table}"
    daily.bronze_to_silver(spark, table, bronze_path, silver_path, rejects_date="d")
    raw = src.read_csv_inferred(spark, bronze_path, multiline=table in contracts.MULTILINE).count()
    silver = src.read_parquet(spark, silver_path).count()
    schema = {**contracts.BRONZE[table], "raw_line": {"type": contracts.STR}, "reason": {"type": contracts.STR}}
    rejects = src.read_csv(spark, sinks.rejects_path(silver_path, "d"), schema, multiline=True).count()
    assert raw == silver + rejects


@pytest.mark.parametrize("table", list(contracts.BRONZE))
def test_dedup_is_idempotent(spark, table):
    once = rel.dedup_rows(roles.bronze(spark, SF_SMOKE, table))
    assert rel.dedup_rows(once).count() == once.count()
    assert once.exceptAll(rel.dedup_rows(once)).count() == 0


def test_left_lookup_row_count_law(spark):
    products = roles.bronze(spark, SF_SMOKE, "products")
    unique = rel.dedup_rows(roles.bronze(spark, SF_SMOKE, "aisles")).where(F.col("aisle").isNotNull())
    joined = joins.left_lookup(products, unique, {"aisle_id": "aisle_id"}, {"aisle": "aisle"})
    assert checks.duplicate_keys(unique, ["aisle_id"]).count() == 0
    assert joined.count() == products.count()
    repeated = roles.bronze(spark, SF_SMOKE, "aisles")  # one row per part: keys repeat
    fanned = joins.left_lookup(products, repeated, {"aisle_id": "aisle_id"}, {"aisle": "aisle"})
    assert checks.duplicate_keys(repeated, ["aisle_id"]).count() > 0
    assert fanned.count() > products.count()
