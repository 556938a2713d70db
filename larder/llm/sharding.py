"""Sharding by a two-pass external shuffle.

Pass one scatters the records into memory-sized buckets by seeded hashes: the shard is the
one with the largest hash of (seed, id, shard) — so the id and the shard count decide it,
and one more shard takes rows only into itself — and the bucket within the shard is a
second hash. Pass two shuffles every bucket by itself (``shuffle`` is a Fisher-Yates
shuffle) and writes it to its shard's files. A bucket's expected size is ``bucket_bytes``,
whatever the number of records: the second hash is that of the whole record, and of equal
records every ``COPIES`` get a hash of their own.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import scratch_path
from .common import fresh, materialise, quoted, table

SHARDS = 8
SEED = 20_240_229
BUCKET_BYTES = 32 << 20
#: So many equal records share a bucket.
COPIES = 1000


def key_shard(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard of a key among ``shards`` (highest random weight); a null key has one too."""
    weights = F.array(*[F.xxhash64(F.lit(seed), F.lit(s), key) for s in range(shards)])
    return (F.array_position(weights, F.array_max(weights)) - 1).cast("int")


def _numbered(docs: DataFrame, row: str, salt: str, count: bool = True) -> DataFrame:
    """``docs`` with the hash ``row`` of each record and the int ``salt``, its number among the
    equal records divided by ``COPIES``. It depends on the records alone, so a task that is run
    again deals them alike. Only records with more copies than that are counted out, none
    without ``count``."""
    columns = [quoted(c) for c in docs.columns]
    hashed = docs.withColumn(row, F.xxhash64(*columns))
    if not count:
        return hashed.withColumn(salt, F.lit(0))
    crowds = hashed.groupBy(row).count().where(F.col("count") > COPIES).select(row, F.lit(True).alias(salt))
    if crowds.isEmpty():
        return hashed.withColumn(salt, F.lit(0))
    marked = hashed.join(materialise(crowds, "shards-crowds"), row, "left")
    size = fresh(marked.columns, "__size")
    number = F.explode(F.sequence(F.lit(0), F.ceil(F.col(size) / COPIES).cast("int") - 1))
    counted = marked.where(quoted(salt)).groupBy(*columns, row).agg(F.count("*").alias(size)).select(*columns, row, size, number.alias(salt))
    some = F.least(F.lit(COPIES), F.col(size) - F.col(salt) * COPIES).cast("int")
    copies = counted.withColumn(size, F.explode(F.array_repeat(F.lit(0), some))).select(*columns, row, salt)
    return marked.where(quoted(salt).isNull()).select(*columns, row, F.lit(0).alias(salt)).union(copies)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                 seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``docs`` shuffled into ``shards`` folders ``shard=<n>`` under ``path``; read them back.

    Returns the columns of ``docs`` and ``shard``, ``bucket`` and ``place`` (the record's
    place in its bucket; names get an underscore if ``docs`` has them). Null ids share a shard,
    null texts count no bytes, repeated rows are all kept; an empty table gives no files and
    no rows. A bucket with one text longer than ``bucket_bytes`` is as large as that text.
    """
    key, text = quoted(id_col), quoted(text_col)
    shard, bucket, place = (fresh(docs.columns, c) for c in ("shard", "bucket", "place"))
    total = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 1)).first()[0] or 0
    buckets = max(1, ceil(total / shards / bucket_bytes))
    row, salt = fresh([*docs.columns, shard, bucket], "__row"), fresh([*docs.columns, shard, bucket], "__salt")
    rows = _numbered(docs, row, salt, buckets > 1)
    scattered = rows.select(*[quoted(c) for c in docs.columns], key_shard(key, shards, seed).alias(shard),
                            F.pmod(F.xxhash64(F.lit(seed + 1), row, salt), F.lit(buckets)).cast("int").alias(bucket))
    whole = F.struct(*[quoted(c) for c in docs.columns])
    number = fresh(scattered.columns, "__number")
    # Exactly one bucket for each task; the order before the shuffle does not depend on the run.
    grouped = (scattered.withColumn(number, F.col(shard) * buckets + F.col(bucket)).repartitionById(shards * buckets, number)
               .sortWithinPartitions(key, row, salt)
               .groupBy(number).agg(F.collect_list(whole).alias("rows"))
               .select(F.floor(F.col(number) / buckets).cast("int").alias(shard), (F.col(number) % buckets).alias(bucket), F.shuffle("rows", seed).alias("rows")))
    out = (grouped.select(shard, bucket, F.posexplode("rows").alias(place, "row"))
           .select(*[F.col("row").getField(c).alias(c) for c in docs.columns], bucket, place, shard))
    out.sortWithinPartitions(shard, bucket, place).write.partitionBy(shard).parquet(path)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.IntegerType()) for c in (bucket, place, shard)]])
    return docs.sparkSession.read.schema(schema).parquet(path)


def slots(written: DataFrame, shard: str = "shard", bucket: str = "bucket", place: str = "place", out: str = "slot") -> DataFrame:
    """``written`` with the record's gapless place in its shard (buckets one after another)."""
    before = Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = written.groupBy(shard, bucket).agg(F.count("*").alias("__n"))
    starts = counts.select(shard, bucket, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return written.join(starts, [shard, bucket]).withColumn(out, F.col("__start") + F.col(place)).drop("__start")


def op8_two_pass_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    written = write_shards(docs, scratch_path(spark, "shards"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1
    digest = written.select("doc_id", size.alias("size"), F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"),
                            "shard", "bucket", "place")
    return slots(digest).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
                                key_shard(F.col("doc_id"), SHARDS + 1).alias("grown_shard"))
