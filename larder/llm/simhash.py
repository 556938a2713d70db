"""Near-duplicates by SimHash fingerprints, compared through pivot distance tables.

A fingerprint has bit b set if over half of the text's shingle hashes have it. Two
fingerprints link if they differ in ``max_distance`` bits or fewer. For every distinct
fingerprint the Hamming distances to fixed reference fingerprints (rows of a Walsh
matrix) are computed once: if two fingerprints are within d, each of these coordinates
differs by d at most (triangle inequality), so a pair with a larger difference in any
coordinate is discarded without looking at the fingerprints; survivors are verified.

A pivot table alone still meets every pair. So pairs meet only under a shared block key:
cut into ``blocks`` blocks, two fingerprints within d agree on at least ``blocks - d`` of
them, and one key for each choice of that many blocks finds every pair (exactly, for any
number of blocks; more blocks mean more keys and smaller groups, and the count is chosen
from the number of distinct fingerprints by expected work). Groups over ``CHUNK`` rows
are dealt out as pairs of chunks, so no task holds more than two chunks of one group.
Inside a group only a spanning forest of the links is emitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, map_arrow, materialise, quoted, runs, slices, table, utf8
from .components import components

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
PIVOTS = 16
CHUNK = 4096
#: Groups up to this size are compared with shifted arrays, larger ones row by row.
SMALL = 64
#: Hashes that are turned into bits at a time.
BIT_ROWS = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit fingerprint of one text; zero if it has no word."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        begins = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(
            begins[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist(), strict=True)], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), BIT_ROWS):
        rows = hashes[k: k + BIT_ROWS].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def add_fingerprint(docs: DataFrame, text_col: str = "text", out: str = "fingerprint", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with the long column ``out``; a null text counts as empty; a column of that
    name is replaced."""
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                found = pa.array([fingerprint(t, shingle) for t in utf8(part.column(text_col))], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*part.schema.names, out])

    return map_arrow(docs, work, schema)


def pivots(count: int = PIVOTS) -> list[int]:
    """Reference fingerprints: ``count`` rows of the 64 x 64 Walsh matrix (bit i of row k is
    the parity of k & i), spread over the rows by an odd step; as signed longs."""
    rows = [sum(((k & i).bit_count() & 1) << i for i in range(64)) for k in ((1 + 27 * j) % 64 for j in range(count))]
    return [r - (1 << 64) if r >> 63 else r for r in rows]


def block_masks(n: int, distance: int) -> list[int]:
    """Bit masks of the keys for ``n`` distinct fingerprints: the cheapest exact plan.

    With b blocks there are C(b, b-d) keys of about 64(b-d)/b bits. Work is taken as one
    unit a row and key, and 1/200 a pair that is expected under a key.
    """
    if not 0 <= distance < 64:
        raise ValueError("distance must lie between 0 and 63")
    plans = range(distance + 1, min(64, distance + 4) + 1)
    work = {b: comb(b, distance) * (n + n * n / 2.0 ** (64 * (b - distance) // b + 1) / 200) for b in plans}
    b = min(work, key=work.get)
    cuts = [64 * k // b for k in range(b + 1)]
    blocks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    masks = [sum(c) for c in combinations(blocks, b - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _forest(fp: np.ndarray, table_: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Spanning edges of the links among the rows of one group, by breadth-first search."""
    left = np.arange(len(fp))
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = left
            for c in range(table_.shape[1]):  # a coordinate at a time: few rows are left after some
                near = near[np.abs(table_[near, c] - table_[at, c]) <= distance]
                if not len(near):
                    break
            near = near[np.bitwise_count(fp[near] ^ fp[at]) <= distance]
            if len(near):
                for k in near.tolist():
                    yield int(at), k
                frontier += near.tolist()
                left = np.setdiff1d(left, near, assume_unique=True)


def _links(fp: np.ndarray, table_: np.ndarray, group: np.ndarray, sizes: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning edges (row, row) of all complete groups; ``group`` numbers the rows' groups."""
    begin = np.cumsum(sizes) - sizes
    edges: list[tuple[int, int]] = []
    small = (sizes[group] <= SMALL) & (sizes[group] > 1)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    rows = np.flatnonzero(small)
    for lag in range(1, int(sizes[sizes <= SMALL].max(initial=1))):
        rows = rows[rows + lag < len(fp)]
        rows = rows[group[rows] == group[rows + lag]]
        if not len(rows):
            break
        a = rows
        for c in range(table_.shape[1]):
            a = a[np.abs(table_[a, c] - table_[a + lag, c]) <= distance]
        a = a[np.bitwise_count(fp[a] ^ fp[a + lag]) <= distance]
        for i in a.tolist():
            x, y = root(i), root(i + lag)
            if x != y:
                parent[x] = y
                edges.append((i, i + lag))
    for g in np.flatnonzero(sizes > SMALL).tolist():
        lo, hi = begin[g], begin[g] + sizes[g]
        edges += [(lo + i, lo + j) for i, j in _forest(fp[lo:hi], table_[lo:hi], distance)]
    return edges


def links(prints: DataFrame, distance: int = MAX_DISTANCE, n: int | None = None) -> DataFrame:
    """(src, dst) edges that join all linked fingerprints of the distinct column ``fp``.

    The edges are a spanning forest of each group of rows that share a key, so they have
    the same connected components as all links, and each edge is a link.
    """
    refs = pivots()
    masks = block_masks(prints.count() if n is None else n, distance)
    keyed = prints.select(
        "fp", F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("tinyint") for p in refs]).alias("dist"),
    ).select("fp", "dist", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(masks)])).alias("at"),
    ).select(F.col("at.k").alias("k"), F.col("at.key").alias("key"), "fp", "dist")
    crowded = (keyed.groupBy("k", "key").agg(F.count("*").alias("size")).where(F.col("size") > CHUNK)
               .select("k", "key", F.ceil(F.col("size") / CHUNK).cast("int").alias("chunks")))
    crowded = materialise(crowded, "simhash-crowded")
    lone = F.lit(0).alias("pair")
    if crowded.isEmpty():
        dealt = keyed.select("k", "key", lone, "fp", "dist")
    else:
        # Chunk c of a crowded group goes to the pairs (c, 0..chunks-1), numbered low * chunks + high.
        c, n_ = F.col("c"), F.col("chunks")
        dealt = (keyed.join(crowded, ["k", "key"], "left").withColumn("c", F.pmod(F.xxhash64("fp"), n_))
                 .withColumn("other", F.explode(F.when(n_.isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), n_ - 1))))
                 .select("k", "key", F.coalesce(F.least(c, F.col("other")) * n_ + F.greatest(c, F.col("other")), F.lit(0)).cast("int").alias("pair"), "fp", "dist"))
    dealt = dealt.repartition("k", "key", "pair").sortWithinPartitions("k", "key", "pair", "fp")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solve(rows: pa.Table, keep_last: bool) -> tuple[pa.RecordBatch | None, pa.Table]:
            keys = [rows.column(c).to_numpy() for c in ("k", "key", "pair")]
            begins = runs(*keys)
            cut = int(begins[-1]) if keep_last and len(begins) else rows.num_rows
            begins = begins[begins < cut]
            if not len(begins):
                return None, rows.slice(cut)
            fp = rows.column("fp").to_numpy()[:cut].view(np.uint64)
            dist = rows.column("dist").slice(0, cut).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(cut, -1)
            sizes = np.diff(np.append(begins, cut))
            edges = _links(fp, dist, np.repeat(np.arange(len(begins)), sizes), sizes, distance)
            out = None
            if edges:
                pairs = np.array(edges)
                out = pa.RecordBatch.from_arrays([pa.array(fp[pairs[:, k]].view(np.int64)) for k in (0, 1)], names=["src", "dst"])
            return out, rows.slice(cut)

        for batch in batches:
            if not batch.num_rows:
                continue
            out, rest = solve(pa.Table.from_batches([*held, batch]), True)
            held = rest.combine_chunks().to_batches()
            if out is not None:
                yield out
        if held:
            out, _ = solve(pa.Table.from_batches(held), False)
            if out is not None:
                yield out

    return map_arrow(dealt, work, "src long, dst long").distinct()


def classes(prints: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Distinct long fingerprints ``fp`` -> (fp, root): the smallest linked fingerprint."""
    n = prints.count()
    found = components(links(prints, distance, n), "simhash-components")
    return prints.join(found, prints.fp == found.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """(id_col, fingerprint long, component): one row for each row of ``docs``.

    ``component`` is the smallest id reachable by links, null if the group has only null
    ids. Null and empty texts have fingerprint zero and link like any other; repeated rows
    are returned as often as they come; an empty table gives no rows; other columns are
    not read. One text and its words must fit a task's memory.
    """
    base = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    marked = materialise(add_fingerprint(base, "text", "fp", shingle).select("id", "fp"), "simhash-prints")
    prints = marked.groupBy("fp").agg(F.min("id").alias("low"))
    prints = materialise(prints, "simhash-distinct")
    found = classes(prints.select("fp"), distance)
    lows = found.join(prints, "fp").groupBy("root").agg(F.min("low").alias("component"))
    lows = materialise(lows, "simhash-lows")  # a stored side lets the join split a large component
    owner = found.join(lows, "root").select("fp", "component")
    return marked.join(owner, "fp").select(F.col("id").alias(id_col), F.col("fp").alias("fingerprint"), "component")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with one row of each group of linked texts: the smallest id, nulls last.

    Among rows of that id one stays, so repeated rows go too. All columns are kept.
    """
    fp, uid = fresh(docs.columns, "__fp"), fresh(docs.columns, "__uid")
    marked = materialise(add_fingerprint(docs, text_col, fp, shingle).withColumn(uid, F.monotonically_increasing_id()), "simhash-docs")
    first = F.min(F.struct(quoted(id_col).isNull().alias("none"), quoted(id_col).alias("id"), quoted(uid).alias("uid")))
    prints = materialise(marked.groupBy(quoted(fp).alias("fp")).agg(first.alias("low")), "simhash-distinct")
    found = classes(prints.select("fp"), distance)
    keep = found.join(prints, "fp").groupBy("root").agg(F.min("low").alias("low")).select(F.col("low.uid").alias(uid))
    return marked.join(keep, uid, "left_semi").select(*[quoted(c) for c in docs.columns])


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))
