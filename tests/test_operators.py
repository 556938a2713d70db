"""Projection/filter/dedup, set operations, lookup joins, clustering and key-safe append."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.operators import joins, relational as rel, setops
from larder.operators.keys import new_keys_only
from larder.operators.partitioning import cluster_by
from larder.operators.registry import TRANSFORMS, apply_transform, get_transform, transform


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_not_null_and_dedup(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (3, None)], "aisle_id int, aisle string")
    assert bag(rel.not_null(df, "aisle")) == [(1, "x"), (1, "x"), (2, "y")]
    assert bag(rel.dedup_rows(df)) == [(1, "x"), (2, "y"), (3, None)]
    plan = rel.not_null(df, "aisle")._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(aisle" in plan


def test_dedup_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, None), (None, None), (1, None)], "a int, b string")
    assert bag(rel.dedup_rows(df)) == [(1, None), (None, None)]


def test_rename_and_select_as(spark):
    df = spark.createDataFrame([(1, "n", 7)], "id int, fullname string, location_area_id int")
    out = rel.rename(df, {"id": "client_id", "location_area_id": "area_id"})
    assert out.columns == ["client_id", "fullname", "area_id"]
    sel = rel.select_as(df, {"store_id": "id", "twice": F.col("id") * 2})
    assert sel.columns == ["store_id", "twice"] and bag(sel) == [(1, 2)]


def test_union_is_positional_bag_and_distinct(spark):
    a = spark.createDataFrame([(1,), (1,)], "x int")
    b = spark.createDataFrame([(1,), (2,)], "y int")
    u = setops.union_all(a, b)
    assert u.columns == ["x"] and bag(u) == [(1,), (1,), (1,), (2,)]
    assert bag(setops.union_distinct(a, b)) == [(1,), (2,)]


def test_reject_law_on_the_documented_fixture(spark):
    raw = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (3, None)], "aisle_id int, aisle string")
    clean = apply_transform(raw, "transform_aisles")
    rejects = setops.bag_difference(raw, clean)
    assert bag(rejects) == [(1, "x"), (3, None)]
    assert raw.count() == clean.count() + rejects.count()


def test_align_types_string_against_declared_int(spark):
    raw = spark.createDataFrame([("bad", "y"), ("1", "x")], "aisle_id string, aisle string")
    clean = spark.createDataFrame([(1, "x")], "aisle_id int, aisle string")
    assert bag(setops.bag_difference(raw, clean)) == [("bad", "y")]


def test_align_types_never_narrows(spark):
    raw = spark.createDataFrame([(1, "x"), (3_000_000_000, "y")], "aisle_id bigint, aisle string")
    clean = spark.createDataFrame([(1, "x")], "aisle_id int, aisle string")
    out = setops.bag_difference(raw, clean)
    assert out.schema["aisle_id"].dataType.simpleString() == "bigint"
    assert bag(out) == [(3_000_000_000, "y")] == bag(raw.exceptAll(clean))
    halves = spark.createDataFrame([(1.5, "x"), (1.0, "x")], "aisle_id double, aisle string")
    assert bag(setops.bag_difference(halves, clean)) == [(1.5, "x")]
    dates = spark.sql("SELECT timestamp'2021-01-01 05:00:00' AS d")
    assert setops.bag_difference(dates, spark.sql("SELECT date'2021-01-01' AS d")).count() == 1
    assert bag(setops.bag_difference(spark.sql("SELECT true AS b"), spark.sql("SELECT 1 AS b"))) == [("true",)]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    left=st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), max_size=25),
    right=st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), max_size=25),
)
def test_bag_difference_equals_except_all(spark, left, right):
    schema = "k int, v string"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    # A tiny chunk size makes every value with several copies go through the chunked path.
    assert bag(setops.bag_difference(a, b, chunk_rows=2)) == bag(a.exceptAll(b))


def test_bag_difference_spreads_a_hot_value_over_chunks(spark):
    hot = spark.range(10_000).select(F.lit(7).alias("k"), F.lit("hot").alias("v"))
    other = spark.createDataFrame([(7, "hot")], "k int, v string")
    out = setops.bag_difference(hot.select(F.col("k").cast("int"), "v"), other, chunk_rows=1_000)
    assert out.count() == 9_999
    per_partition = out.rdd.glom().map(len).collect()
    assert sum(1 for n in per_partition if n) > 1


def test_left_lookup_fan_out_nulls_and_unmatched(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 99)], "id int, type_id int")
    lookup = spark.createDataFrame([(10, "a"), (20, "b"), (20, "b2")], "type_id int, type string")
    out = joins.left_lookup(facts, lookup, {"type_id": "type_id"}, {"type": "type"})
    assert out.columns == ["id", "type_id", "type"]
    assert bag(out) == [(1, 10, "a"), (2, 20, "b"), (2, 20, "b2"), (3, None, None), (4, 99, None)]


def test_lookup_with_array_columns_is_not_broadcast_unchecked(spark, out):
    """Long arrays per row: the planner goes by the real bytes, nothing forces a broadcast."""
    facts = spark.range(100).selectExpr("CAST(id AS INT) AS id", "CAST(id % 5 AS INT) AS type_id")
    spark.range(5).selectExpr("CAST(id AS INT) AS type_id", "transform(sequence(1, 600000), x -> x * (id + 7)) AS wide").write.parquet(f"{out}/wide")
    joined = joins.left_lookup(facts, spark.read.parquet(f"{out}/wide"), {"type_id": "type_id"}, {"wide": "wide"})
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()
    sized = joined.selectExpr("id", "element_at(wide, 1) AS w")  # the arrays go through the join
    assert sized.count() == 100
    sized.collect()
    final = sized._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" not in final


def test_new_keys_only(spark):
    existing = spark.createDataFrame([(1, "a"), (2, "b"), (None, "z")], "k int, v string")
    new = spark.createDataFrame([(2, "b"), (3, "c"), (3, "c"), (None, "n")], "k int, v string")
    assert bag(new_keys_only(new, existing, ["k"])) == [(3, "c")]
    assert bag(new_keys_only(new, existing.where("k IS NOT NULL"), ["k"])) == [(3, "c"), (None, "n")]
    assert new_keys_only(new, new, ["k"]).count() == 0


def test_cluster_by(spark):
    df = spark.range(1000).select((F.col("id") % 5).alias("store_id"), "id")
    fixed = cluster_by(df, "store_id", num_partitions=4)
    assert fixed.rdd.getNumPartitions() == 4 and fixed.count() == 1000
    assert "REBALANCE" in cluster_by(df, "store_id")._jdf.queryExecution().executedPlan().toString().upper()


def test_registry(spark):
    assert {"transform_common", "transform_aisles", "transform_departments", "transform_types"} <= set(TRANSFORMS)

    @transform("test_keep_positive")
    def keep_positive(df):
        return df.where("x > 0")

    df = spark.createDataFrame([(1,), (-1,)], "x int")
    assert bag(apply_transform(df, "test_keep_positive")) == [(1,)]
    assert get_transform("test_keep_positive") is keep_positive


def test_rejects_with_reason(spark):
    from larder.quality.checks import rejects_with_reason

    raw = spark.createDataFrame([(1, "x"), (1, "x"), (1, "x"), (2, "y"), (3, None), (3, None)],
                                "aisle_id int, aisle string")
    got = bag(rejects_with_reason(raw, ["aisle"], chunk_rows=1))
    assert got == [(1, "x", "duplicate"), (1, "x", "duplicate"), (3, None, "null:aisle"), (3, None, "null:aisle")]
    clean = apply_transform(raw, "transform_aisles")
    assert raw.count() == clean.count() + len(got)
    marked = spark.createDataFrame([(1, "x", None), (1, "x", None), (None, "y", "bad,y"), (None, "y", "bad,y"), (2, None, "2,,extra"), (3, None, None)],
                                   "aisle_id int, aisle string, _corrupt_record string")
    assert bag(rejects_with_reason(marked, ["aisle"], corrupt_column="_corrupt_record")) == bag(spark.createDataFrame(
        [(1, "x", None, "duplicate"), (None, "y", "bad,y", "malformed"), (None, "y", "bad,y", "malformed"), (2, None, "2,,extra", "malformed"),
         (3, None, None, "null:aisle")], "aisle_id int, aisle string, raw_line string, reason string"))
    assert bag(setops.replicate(spark.createDataFrame([("a", 3), ("b", 0)], "v string, n long"), "n")) == \
        [("a",), ("a",), ("a",)]
