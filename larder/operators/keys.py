"""K5b — key-safe append: keep only rows whose key is not already in the target."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.files import write_parquet
from ..storage import children


def new_keys_only(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each key of ``new`` that does not occur in ``existing``.

    Keys are compared null-safe: a NULL key that is already there is not appended again.
    Re-running an append for a day that was already loaded then appends nothing instead of
    failing on the warehouse primary key, and a key repeated in ``new`` is appended once.
    Only the key columns of ``existing`` are read.
    """
    there = existing.select(*keys)
    same = reduce(lambda a, b: a & b, [new[k].eqNullSafe(there[k]) for k in keys])
    return new.join(there, same, "left_anti").dropDuplicates(list(keys))


BUCKET = "bucket"
#: Folders of a key table; a load reads at most one for each of its new keys.
BUCKETS = 1024


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row's key; NULL keys have one too."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _key_folder(path: str, buckets: int) -> str:
    return f"{path.rstrip('/')}/buckets-{buckets}"


def add_keys(df: DataFrame, path: str, keys: Sequence[str], *, buckets: int = BUCKETS, mode: str = "append") -> None:
    """Store the keys of ``df`` in the key table at ``path``: one folder for each hash bucket."""
    spark = df.sparkSession
    other = [n for n in children(spark, path) if n.startswith("buckets-") and n != f"buckets-{buckets}"]
    if other:
        raise ValueError(f"{path} is a key table of {other[0]}, not of {buckets} buckets")
    rows = df.select(*keys).withColumn(BUCKET, bucket_of(keys, buckets))
    write_parquet(rows, _key_folder(path, buckets), mode=mode, partition_by=BUCKET)


def keys_near(new: DataFrame, path: str, keys: Sequence[str], *, buckets: int = BUCKETS) -> DataFrame:
    """The stored keys that share a bucket with a key of ``new``: only those buckets are read.

    The buckets of the new keys come to the driver: at most ``buckets`` small numbers.
    """
    spark = new.sparkSession
    near = [r[0] for r in new.select(bucket_of(keys, buckets)).distinct().collect()]
    folder = _key_folder(path, buckets)
    if not any(n.startswith(f"{BUCKET}=") for n in children(spark, folder)):
        return new.select(*keys).limit(0)
    struct = new.select(*keys).schema.add(BUCKET, T.IntegerType())
    return spark.read.schema(struct).parquet(folder).where(F.col(BUCKET).isin(near)).select(*keys)


def new_keys_bucketed(new: DataFrame, path: str, keys: Sequence[str], *, buckets: int = BUCKETS) -> DataFrame:
    """``new_keys_only`` against a key table: its cost follows the new keys' buckets, not the history."""
    return new_keys_only(new, keys_near(new, path, keys, buckets=buckets), keys)
