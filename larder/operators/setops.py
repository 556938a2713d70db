"""Set operations (U1–U3) and the type alignment the reject diff needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of one distinct value regenerated by a single task in ``bag_difference``.
DEFAULT_CHUNK_ROWS = 1_000_000


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """U1 — positional UNION ALL (column names come from ``left``)."""
    return left.union(right)


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """U2 — SQL UNION: positional union, then distinct (partial aggregation first)."""
    return left.union(right).distinct()


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONS = (T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type in which values of ``a`` and ``b`` are compared; never narrower than either."""
    if a == b:
        return a
    if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
        return max(a, b, key=lambda t: _INTEGERS.index(type(t)))
    if isinstance(a, (*_INTEGERS, *_FRACTIONS)) and isinstance(b, (*_INTEGERS, *_FRACTIONS)):
        return T.DoubleType()
    if isinstance(a, _TIMES) and isinstance(b, _TIMES):
        return T.TimestampType()
    return T.StringType()


def align_types(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Positionally cast both sides to one type per column that holds the values of both.

    No side is narrowed: integers meet in the wider one, an integer and a fraction in
    double, a date and a timestamp in the timestamp, all else as strings. A value that one
    side could not hold (3000000000 or 1.5 against a declared int) therefore stays what it
    was read as. Output names are ``left``'s.
    """
    if len(left.columns) != len(right.columns):
        raise ValueError(f"column count differs: {len(left.columns)} vs {len(right.columns)}")
    lcols: list[Column] = []
    rcols: list[Column] = []
    for lf, rf in zip(left.schema.fields, right.schema.fields):
        lc, rc = F.col(f"`{lf.name}`"), F.col(f"`{rf.name}`")
        common = common_type(lf.dataType, rf.dataType)
        lcols.append((lc if lf.dataType == common else lc.cast(common)).alias(lf.name))
        rcols.append((rc if rf.dataType == common else rc.cast(common)).alias(lf.name))
    return left.select(*lcols), right.select(*rcols)


def bag_difference(left: DataFrame, right: DataFrame, *, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """U3 — EXCEPT ALL: each row of ``left`` as many times as it outnumbers ``right``.

    Same result as ``left.exceptAll(right)`` but skew-safe: copies are counted with a
    partial + final aggregate (a hot value collapses before the shuffle), and the
    surviving copies are regenerated in chunks of ``chunk_rows`` spread over tasks, so a
    value that makes up a third of the input is not re-expanded by one task.
    """
    left, right = align_types(left, right)
    cols = left.columns
    n = "__larder_n"
    tagged = left.withColumn(n, F.lit(1)).unionByName(right.withColumn(n, F.lit(-1)))
    counts = tagged.groupBy(*cols).agg(F.sum(n).alias(n)).where(F.col(n) > 0)
    return replicate(counts, n, chunk_rows=chunk_rows).select(*[F.col(f"`{c}`") for c in cols])


def replicate(df: DataFrame, count_col: str, *, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Each row of ``df`` repeated ``count_col`` times (rows with a count <= 0 vanish).

    Copies are produced in chunks of at most ``chunk_rows``; the chunks are hash-spread
    over tasks first, so one row with a huge count is expanded by many tasks.
    """
    cols = [c for c in df.columns if c != count_col]
    n, chunk = count_col, "__larder_chunk"
    counts = df.where(F.col(n) > 0)
    size = F.lit(chunk_rows).cast("long")
    chunks = counts.withColumn(
        chunk, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / size).cast("long")))
    )
    # The chunk rows are tiny but each expands to up to ``chunk_rows`` rows, so their
    # shuffle size says nothing about the work: an explicit partition count keeps adaptive
    # execution from folding all chunks back into one task.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    spread = chunks.repartition(tasks, F.xxhash64(*[F.col(f"`{c}`") for c in cols], F.col(chunk)))
    rows_in_chunk = F.least(size, F.col(n) - F.col(chunk) * size)
    return (
        spread.withColumn("__larder_i", F.explode(F.sequence(F.lit(1).cast("long"), rows_in_chunk)))
        .select(*[F.col(f"`{c}`") for c in cols])
    )
