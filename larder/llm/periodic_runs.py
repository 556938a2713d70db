"""Periodic runs: maximal stretches of a text that repeat with a period, on tiles of each period octave.

A run is a stretch of words with smallest period q (words q apart are equal) and a length of
at least ``max(MIN_WORDS, 3 * q)`` that no neighbouring word extends with that period.

1. *Tiles.* Periods are taken by octave: 1 to 7, then P to 2P - 1 for P = 8, 16, 32, ... For an
   octave a text is covered by tiles that overlap by 6P words, so every stretch of 3q words
   lies in a tile. A run's words repeat a whole block of P words that begins at a multiple of P
   (a boundary) at the distance q; tiles without such a block (compared by hash) hold no run
   and are not made.
2. *Boundary Z-functions.* Each tile is solved by itself: at every boundary c the Z-function
   says how far the words from c on equal those from c + q on, the Z-function of the reversed
   tile how far the words before c do, for all q of the octave at once. Both are read off exact
   names of the blocks of 1, 2, 4, ... words (Karp, Miller and Rosenberg), longest blocks first.
3. *Stitching.* Fragments are shuffled by document and period; two that share q words or more
   are one. A stretch found under several periods has the smallest.

A tile's cost is its length times its logarithm, whatever it repeats, and the tiles of one
long text are solved by many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, map_arrow, materialise, quoted, slices, table, utf8

#: Words of the shortest run.
MIN_WORDS = 24
#: Words from one tile's begin to the next one's, at least.
TILE_STEP = 4096
#: Smallest boundary distance; shorter periods share the first octave.
LEAST = 8
#: Words of tiles that one output batch holds at most, unless one tile is longer.
BATCH_WORDS = 1 << 20
#: Bytes of tiles that a task solves.
TASK_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... n-1 modulo 2**64; a worker keeps them for its longest text."""
    if len(_POWERS.get(base, ())) < n:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        _POWERS[base] = np.multiply.accumulate(out)
    return _POWERS[base][:n]


def octaves(n: int) -> Iterator[tuple[int, int, int]]:
    """(boundary distance, smallest period, end of periods) of the octaves for a text of n words."""
    if n >= MIN_WORDS:
        yield LEAST, 1, LEAST
    p = LEAST
    while 3 * p <= n:
        yield p, p, 2 * p
        p *= 2


def _step(p: int) -> int:
    return max(TILE_STEP, 6 * p)


def tiles(ids: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(boundary distance, smallest period, begin, end) of the tiles that may hold a run.

    A block is compared by its hash: a tile may be made in vain, none is missed.
    """
    n = len(ids)
    if n < MIN_WORDS:
        return
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mixed * _powers(_BASE, n), out=sums[1:])
    back = _powers(_INVERSE, n)
    for p, low, high in octaves(n):
        h = (sums[p:] - sums[:-p]) * back[: n - p + 1]
        bounds = (n - p - low) // p + 1
        if bounds <= 0:
            continue
        shift = 0 if low < p else p
        there = np.zeros(bounds * p, dtype=np.uint64)
        some = h[shift: shift + bounds * p]
        there[: len(some)] = some
        equal = there.reshape(bounds, p) == h[: (bounds - 1) * p + 1: p, None]
        equal[:, : low - shift] = False
        c, t = np.nonzero(equal)
        c, q = c * p, t + shift
        inside = c + q + p <= n
        c, q = c[inside], q[inside]
        if not len(c):
            continue
        step, over = _step(p), 6 * p
        count = max(1, -(-(n - over) // step))
        at = np.minimum(c // step, count - 1)
        early = at[(at > 0) & (c + q + p <= at * step + over)] - 1  # in the overlap with the tile before
        for k in np.unique(np.concatenate([at, early])).tolist():
            yield p, low, k * step, n if k == count - 1 else k * step + step + over


def names(ids: np.ndarray) -> list[np.ndarray]:
    """names[k][i]: a number for the 2**k words from i on, equal for equal words alone."""
    out = [ids.astype(np.int64)]
    size = 1
    while 2 * size <= len(ids):
        last = out[-1]
        if int(last.max()) == len(last) - 1 and size > 1:
            break  # numbers are dense from here on: all blocks differ, and longer ones do too
        pairs = last[: len(last) - size] * (int(last.max()) + 1) + last[size:]
        out.append(np.unique(pairs, return_inverse=True)[1].astype(np.int64))
        size *= 2
    return out


def boundary_z(named: list[np.ndarray], c: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each boundary c and period q: how many words from c on equal those from c + q on, and
    how many words before c equal those before c + q."""
    ahead, behind = np.zeros_like(c), np.zeros_like(c)
    for k in range(len(named) - 1, -1, -1):
        name, size = named[k], 1 << k
        last = len(name) - 1
        a, b = c + ahead, c + q + ahead
        ahead = ahead + size * ((b <= last) & (name[np.minimum(a, last)] == name[np.minimum(b, last)]))
        a, b = c - behind - size, c + q - behind - size
        behind = behind + size * ((a >= 0) & (name[np.maximum(a, 0)] == name[np.clip(b, 0, last)]))
    return ahead, behind


def solve(ids: np.ndarray, p: int, low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, begin, end) of the tile's fragments with a period of the octave and the length of a run.

    Of the periods of one fragment only the smallest comes back.
    """
    n, high = len(ids), p if low < p else 2 * p
    named = names(ids)
    level = p.bit_length() - 1
    bounds = np.arange(0, n, p)
    c = np.repeat(bounds, high - low)
    q = np.tile(np.arange(low, high), len(bounds))
    inside = c + q + p <= n
    c, q = c[inside], q[inside]
    if level < len(named):
        same = named[level][c] == named[level][c + q]
        c, q = c[same], q[same]
    else:
        c = q = np.zeros(0, dtype=np.int64)
    ahead, behind = boundary_z(named, c, q)
    begin, end = c - behind, c + q + ahead
    long = end - begin >= np.maximum(MIN_WORDS, 3 * q)
    begin, end, q = begin[long], end[long], q[long]
    order = np.lexsort((q, end, begin))
    begin, end, q = begin[order], end[order], q[order]
    new = np.ones(len(q), dtype=bool)
    new[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    return q[new], begin[new], end[new]


def word_ids(words: list[bytes]) -> np.ndarray:
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), dtype=np.int32, count=len(words))


_TILE = {"step": pa.int64(), "low": pa.int64(), "begin": pa.int64(), "tile": pa.binary()}


def _parts(docs: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """Stored rows: one for each row of ``docs`` (row, id, n_words, SHA-256 of the words joined by
    a blank, and the words themselves if there are tiles) and one for each tile (row, tile).

    A row's number is given in the task that writes it, so it is the same for all that follows.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), quoted(id_col).alias("id"), quoted(text_col).alias("text"))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = {"row": pa.int64(), "id": batch.schema.field("id").type, "n_words": pa.int64(), "plain": pa.string(), "words": pa.binary(), **_TILE}

            def flush(out: list[tuple], fields=fields) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), fields.values(), strict=True)], names=list(fields))

            for part in slices(batch, "text"):
                out, held = [], 0
                for row, i, text in zip(part.column("row").to_pylist(), part.column("id").to_pylist(), utf8(part.column("text")), strict=True):
                    words = text.split()
                    ids, joined, cut = word_ids(words), b" ".join(words), False
                    for p, low, begin, end in tiles(ids):
                        cut = True
                        out.append((row, None, None, None, None, p, low, begin, ids[begin:end].tobytes()))
                        held += end - begin
                        if held >= BATCH_WORDS:
                            yield flush(out)
                            out, held = [], 0
                    out.append((row, i, len(words), hashlib.sha256(joined).hexdigest(), joined if cut else None, None, None, None, None))
                yield flush(out)

    kinds = ["row long", f"id {docs.schema[id_col].dataType.simpleString()}", "n_words long", "plain string", "words binary",
             "step long", "low long", "begin long", "tile binary"]
    return materialise(map_arrow(rows, explode, ", ".join(kinds)), name)


def _runs(parts: DataFrame) -> DataFrame:
    """Stored parts -> (row, runs array<struct<start, length, period>>) of the texts that have runs."""
    cut = parts.where("tile IS NOT NULL").select("row", "step", "low", "begin", "tile")
    total = cut.agg(F.sum(F.octet_length("tile"))).first()[0] or 0
    # A tile takes long for its bytes; the tiles of one text go to many tasks.
    dealt = cut.repartition(max(1, -(-total // TASK_BYTES)), "row", "step", "begin")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, p, low, begin, raw in zip(*(batch.column(c).to_pylist() for c in ("row", "step", "low", "begin", "tile")), strict=True):
                q, lo, hi = solve(np.frombuffer(raw, dtype=np.int32), p, low)
                if len(q):
                    out.append((np.full(len(q), row), q, lo + begin, hi + begin))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out, strict=True)], names=["row", "period", "lo", "hi"])

    found = map_arrow(dealt, find, "row long, period long, lo long, hi long")
    by = Window.partitionBy("row", "period").orderBy("lo", "hi")
    before = F.max("hi").over(by.rowsBetween(Window.unboundedPreceding, -1))
    marked = found.withColumn("new", F.when(before - F.col("lo") >= F.col("period"), 0).otherwise(1))
    stitched = (marked.withColumn("part", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
                .groupBy("row", "period", "part").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    return (stitched.groupBy("row", "lo", "hi").agg(F.min("period").alias("period"))
            .groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
                F.col("lo").alias("start"), (F.col("hi") - F.col("lo")).alias("length"), "period"))).alias("runs")))


def collapsed(words: list[bytes], runs: list[dict]) -> list[bytes]:
    """The words without those that any run contains after its first ``period`` words."""
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for r in runs:
        edge[r["start"] + r["period"]] += 1
        edge[r["start"] + r["length"]] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, start, length, period): one row for each run of each row of ``docs``.

    Null and empty texts and an empty table have no runs; repeated rows come back as often, rows
    of one id each with its own runs; other columns play no part. One text must fit a task's
    memory.
    """
    parts = _parts(docs, id_col, text_col, "runs-parts")
    found = parts.where("n_words IS NOT NULL").select("row", "id").join(_runs(parts), "row")
    return (found.select(F.col("id").alias(id_col), F.explode("runs").alias("r"))
            .select(quoted(id_col), "r.start", "r.length", "r.period"))


def collapse_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each run cut down to its first period.

    The words that stay are joined by one blank; texts without a run (null and empty ones too)
    stay as they are; all rows and columns stay, whatever their names.
    """
    row, spans = fresh(docs.columns, "__row"), fresh(docs.columns, "__runs")
    numbered = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "collapse-rows")
    parts = _parts(numbered, row, text_col, "collapse-parts")
    found = parts.where("n_words IS NOT NULL").select("row", "id").join(_runs(parts), "row")
    marked = numbered.join(found.select(F.col("id").alias(row), F.col("runs").alias(spans)), row, "left").select(*map(quoted, docs.columns), spans)
    at = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                texts = part.column(text_col).to_pylist()
                for k, s in enumerate(part.column(spans).to_pylist()):
                    if s:
                        texts[k] = b" ".join(collapsed(texts[k].encode().split(), s)).decode()
                columns = part.columns[:-1]
                columns[at] = pa.array(texts, part.schema.field(text_col).type)
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names[:-1])

    return map_arrow(marked, work, docs.schema)


def _report(row: dict) -> tuple:
    runs = row["runs"] or []
    listed = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in runs)
    best = max(runs, key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"]), default=None)
    kept = hashlib.sha256(b" ".join(collapsed(row["words"].split(), runs))).hexdigest() if runs else row["plain"]
    top = (best["start"], best["length"], best["period"], 1000 * best["length"] // best["period"]) if best else (None,) * 4
    return (len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), kept)


def run_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, n_runs, the run with the greatest length / period (start,
    length, period, exponent_milli; ties: smallest start, then period; null without a run), and
    the SHA-256 of the list of runs and of the text without the runs' repeats.

    Null and empty texts have no words; repeated rows come back as often; an empty table gives no
    rows; other columns play no part.
    """
    kind = docs.schema[id_col].dataType
    parts = _parts(docs, id_col, text_col, "runs-parts")
    runs = _runs(parts)
    texts = parts.where("n_words IS NOT NULL").select("row", "id", "plain", "words").join(runs, "row", "left").select("id", "plain", "words", "runs")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "words"):
                plain, words, found = (part.column(c).to_pylist() for c in ("plain", "words", "runs"))
                out = [_report({"plain": p, "words": w, "runs": r}) for p, w, r in zip(plain, words, found, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True))],
                                                 names=["id", *fields])

    fields = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    schema = T.StructType([T.StructField("id", kind), *(T.StructField(f, T.LongType() if k == pa.int64() else T.StringType()) for f, k in zip(fields, kinds, strict=True))])
    return map_arrow(texts, work, schema).withColumnRenamed("id", id_col)


def plant(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text_col) where a tenth of the texts, by the CRC-32 of the decimal id, repeat from
    some word on; a row without an id stays as it is, a planted text's words are joined by a blank."""
    chosen = docs.select(quoted(id_col).alias(id_col), quoted(text_col).alias(text_col))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                texts = part.column(text_col).to_pylist()
                for k, i in enumerate(part.column(id_col).to_pylist()):
                    if i is None or (h := crc32(str(i).encode())) % 10 or not texts[k]:
                        continue
                    words, g = texts[k].encode().split(), h // 10
                    if words:
                        a = g % len(words)
                        p = 1 + (len(words) - a) // (3 + g % 8)
                        period = words[a: a + p]
                        rest = period * (-(-(len(words) - a) // p))
                        texts[k] = b" ".join(words[:a] + rest[: len(words) - a]).decode()
                yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(texts, part.schema.field(text_col).type)], names=[id_col, text_col])

    return map_arrow(chosen, work, chosen.schema)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(plant(table(spark, sf_dir, "documents")))
