"""Approximate nearest neighbours by cross-polytope hashing.

Unit vectors are turned by pseudo-random rotations (three rounds of random signs and a fast
Hadamard transform); a vector's bucket in a table is the signed axis its rotation is nearest to
(Andoni et al., "Practical and optimal LSH for angular distance", 2015). A query probes, in each
table, the buckets of its ``probes`` nearest signed axes.

Index rows and probes meet by table and bucket. A bucket's rows are dealt into blocks of about
``BLOCK_ROWS`` by a hash of the row, its queries into blocks of ``BLOCK_QUERIES``; every block of
queries meets every block of rows of its bucket in one task, as matrix products, and keeps the
nearest candidates of each query: a bucket with a third of all rows is more blocks. Candidates of
all blocks are reranked by the exact distance of the original vectors. Queries with fewer than k
found (small or lopsided tables) are searched again through all buckets of one table, which is
exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, materialise, quoted, table

TABLES = 2
PROBES = 40
SEED = 42
#: Index rows and queries of one bucket that meet in a task, at most.
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 8_192
#: A bucket of more rows than this many mean buckets of its table is cut into blocks too.
HOT = 2
#: Distances that are computed at a time.
STEP_CELLS = 1 << 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row; the length is a power of two."""
    n = x.shape[1]
    step = 1
    while step < n:
        pairs = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x


def rotate(unit: np.ndarray, number: int, seed: int = SEED) -> np.ndarray:
    """Pseudo-random rotation ``number`` of each row, padded with zeros to a power of two."""
    n = unit.shape[1]
    size = 1 << max(0, n - 1).bit_length()
    x = np.zeros((len(unit), size))
    x[:, :n] = unit
    signs = np.random.default_rng([seed, number, size]).integers(0, 2, (3, size)) * 2.0 - 1.0
    for s in signs:
        x = hadamard(x * s)
    return x


def axes(turned: np.ndarray) -> np.ndarray:
    """The nearest signed axis of each row: 2 * axis, and one more if its sign is minus."""
    at = np.abs(turned).argmax(axis=1)
    return 2 * at + (turned[np.arange(len(turned)), at] < 0)


def probe_axes(turned: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row, nearest first (all, if there are fewer)."""
    both = np.stack([turned, -turned], axis=2).reshape(len(turned), -1)
    return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def vectors(df: DataFrame, id_col: str, vec_col: str, single: bool) -> DataFrame:
    """(id, n, vec binary) of the rows that take part: with an id, and a vector that is not zero and
    has no null or non-finite component; ``vec`` holds floats if ``single``, else doubles."""
    kind, bits = ("float", np.dtype("<f4")) if single else ("double", np.dtype("<f8"))
    base = (df.select(quoted(id_col).cast("bigint").alias("id"), quoted(vec_col).cast(f"array<{kind}>").alias("vec"))
            .where("id IS NOT NULL AND size(vec) > 0"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vec")
            sizes = lists.value_lengths().to_numpy()
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(bits)  # a null component is not a number
            begin = np.cumsum(sizes) - sizes
            none = np.zeros(0, dtype=bool)
            fine = np.logical_and.reduceat(np.isfinite(flat), begin) & np.logical_or.reduceat(flat != 0, begin) if len(sizes) else none
            keep = np.flatnonzero(fine)
            raw = [flat[a: a + n].tobytes() for a, n in zip(begin[keep].tolist(), sizes[keep].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(keep)), pa.array(sizes[keep], pa.int32()), pa.array(raw, pa.binary())], names=["id", "n", "vec"])

    return map_arrow(base, work, "id long, n int, vec binary")


def _matrix(raw: list[bytes], n: int) -> np.ndarray:
    x = b"".join(raw)
    return np.frombuffer(x, dtype="<f4" if len(x) == 4 * n * len(raw) else "<f8").reshape(-1, n).astype(np.float64)


def _hashed(rows: DataFrame, tables: int, probes: int | None, seed: int) -> DataFrame:
    """(n, tab, bucket, id, vec): a row for each table and bucket of a vector (``probes`` None), or
    for each table and probe (0: every bucket)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("n").to_numpy()
            for n in np.unique(sizes).tolist():
                part = batch.take(pa.array(np.flatnonzero(sizes == n)))
                x = _matrix(part.column("vec").to_pylist(), n)
                x /= np.abs(x).max(axis=1, keepdims=True)  # the square of a very long or short one would overflow
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                for t in range(tables):
                    turned = rotate(unit, t, seed)
                    found = axes(turned)[:, None] if probes is None else probe_axes(turned, probes or 2 * turned.shape[1])
                    at = pa.array(np.repeat(np.arange(len(x)), found.shape[1]))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("n").take(at), pa.array(np.full(len(at), t), pa.int32()), pa.array(found.ravel().astype(np.int32)),
                         part.column("id").take(at), part.column("vec").take(at)], names=["n", "tab", "bucket", "id", "vec"])

    return map_arrow(rows, work, "n int, tab int, bucket int, id long, vec binary")


def nearest_of_block(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, qx: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's place, id, exact distance) of each query's k nearest rows of the block, ties to the
    smaller id. A query's own row (its id and vector) is left out; rows of one id at one distance
    are one."""
    lengths = (x * x).sum(axis=1)
    step = max(1, STEP_CELLS // len(x))
    out = []
    for lo in range(0, len(qx), step):
        todo, want = np.arange(lo, min(lo + step, len(qx))), k + 1  # one may be the query's own row
        while len(todo):
            some = qx[todo]
            own = (some * some).sum(axis=1)
            if want < len(x):
                size = own[:, None] + lengths[None, :]
                squares, slack = size - 2.0 * (some @ x.T), 1e-9 * size
                # All rows that the rounding of the products may hide among the nearest.
                limit = np.partition(squares + slack, want - 1, axis=1)[:, want - 1]
                row, col = np.nonzero(squares - slack <= limit[:, None])
            else:
                row, col = np.divmod(np.arange(len(some) * len(x)), len(x))
            exact = np.empty(len(row))
            for a in range(0, len(row), 1 << 16):
                d = x[col[a: a + (1 << 16)]] - some[row[a: a + (1 << 16)]]
                exact[a: a + (1 << 16)] = np.sqrt((d * d).sum(axis=1))
            found = ids[col]
            other = (found != qids[todo][row]) | (exact > 0)
            row, found, exact = row[other], found[other], exact[other]
            order = np.lexsort((found, exact, row))
            row, found, exact = row[order], found[order], exact[order]
            new = np.ones(len(row), dtype=bool)
            new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1]) | (exact[1:] != exact[:-1])
            row, found, exact = row[new], found[new], exact[new]
            counts = np.bincount(row, minlength=len(todo))
            rank = np.arange(len(row)) - (np.cumsum(counts) - counts)[row]
            done = counts >= k if want < len(x) else np.ones(len(todo), dtype=bool)
            keep = (rank < k) & done[row]
            out.append((todo[row[keep]], found[keep], exact[keep]))
            todo, want = todo[~done], 4 * want  # repeated rows: look at more
    empty = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
    return tuple(map(np.concatenate, zip(*out, strict=True))) if out else empty


def _search(index: DataFrame, queries: DataFrame, k: int, tables: int, probes: int, seed: int, name: str) -> DataFrame:
    """(query_id, query_key, rank, vec_id, score): each query's k nearest that the probed buckets hold."""
    at = ["n", "tab", "bucket"]
    rows, asked = _hashed(index, tables, None, seed), _hashed(queries, tables, probes, seed)
    # Blocks of each bucket: a row for each table and axis, whatever the number of vectors.
    counts = (rows.select(*at, F.lit(1).alias("r"), F.lit(0).alias("q")).unionAll(asked.select(*at, F.lit(0), F.lit(1)))
              .groupBy(*at).agg(F.sum("r").alias("r"), F.sum("q").alias("q")).where("r > 0 AND q > 0"))
    same = Window.partitionBy("n", "tab")
    blocks = lambda c, most: F.ceil(F.col(c) / F.least(F.lit(most), F.greatest(F.lit(1), F.ceil(HOT * F.avg(c).over(same))))).cast("int")
    heat = materialise(counts.select(*at, blocks("r", BLOCK_ROWS).alias("nr"), blocks("q", BLOCK_QUERIES).alias("nq")), f"{name}-heat")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    hot = lambda df: df.withColumn("key", F.xxhash64("id", "vec")).join(heat, at)
    group = [*at, "rb", "qb"]
    dealt = (hot(rows).withColumn("rb", F.pmod("key", "nr").cast("int")).withColumn("qb", every("nq")).withColumn("asks", F.lit(False))
             .unionByName(hot(asked).withColumn("qb", F.pmod("key", "nq").cast("int")).withColumn("rb", every("nr")).withColumn("asks", F.lit(True))))
    dealt = dealt.select(*group, "asks", "id", "key", "vec").repartition(*group).sortWithinPartitions(*group, "asks")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in group], axis=1)
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            cut = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1) | (asks[1:] != asks[:-1])) + 1).tolist()
            for a, b in zip([0, *cut], [*cut, len(keys)], strict=True):
                part, block = batch.slice(a, b - a), tuple(keys[a].tolist())
                if block != now:
                    now, held = block, []
                ids, x = part.column("id").to_numpy(), _matrix(part.column("vec").to_pylist(), block[0])
                if not asks[a]:
                    held.append((ids, x))
                elif held:
                    held = [tuple(map(np.concatenate, zip(*held, strict=True)))] if len(held) > 1 else held
                    with np.errstate(over="ignore", invalid="ignore"):  # distances beyond doubles are infinite
                        which, found, score = nearest_of_block(*held[0], ids, x, k)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[which]), pa.array(part.column("key").to_numpy()[which]), pa.array(found), pa.array(score)],
                                                     names=["query_id", "query_key", "vec_id", "score"])

    found = map_arrow(dealt, match, "query_id long, query_key long, vec_id long, score double")
    by = Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id")
    # Equal pairs of several tables have one rank.
    return (found.withColumn("rank", F.dense_rank().over(by)).where(F.col("rank") <= k)
            .groupBy("query_id", "query_key", "rank").agg(F.first("vec_id").alias("vec_id"), F.first("score").alias("score")))


def search(index: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
           tables: int = TABLES, probes: int = PROBES, seed: int = SEED) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query up to k rows of ``index``, nearest first by the
    Euclidean distance in double precision, ties to the smaller id.

    A query's own row (its id and vector) is no candidate; rows of one id at one distance are one
    candidate; queries of one id with different vectors are searched each. Rows without an id,
    and vectors that are null, empty, zero, or hold null or non-finite components take no part, on
    either side; vectors meet those of their own length alone. Empty tables give no rows; other
    columns play no part. Recall depends on ``tables`` and ``probes``; a query that finds fewer
    than k is searched in all rows.
    """
    single = all(df.schema[vec_col].dataType == T.ArrayType(T.FloatType(), df.schema[vec_col].dataType.containsNull) for df in (index, queries))
    rows, asked = vectors(index, id_col, vec_col, single), vectors(queries, id_col, vec_col, single)
    first = materialise(_search(rows, asked, k, tables, probes, seed, "nearest"), "nearest-first")
    done = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("query_key").alias("key"))
    short = materialise(asked.withColumn("key", F.xxhash64("id", "vec")).join(done, ["id", "key"], "left_anti").select("id", "n", "vec"), "nearest-short")
    if not short.isEmpty():
        rest = _search(rows, short, k, 1, 0, seed, "nearest-rest")
        first = first.join(done.select(F.col("id").alias("query_id"), F.col("key").alias("query_key")), ["query_id", "query_key"], "left_semi").unionByName(rest)
    return first.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return search(rows, rows.where("vec_id % 100 = 0"))
