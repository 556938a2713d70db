"""Substring dedup: repeated word windows found by suffix automata of reference shards.

A word is removed if a window of ``min_words`` consecutive words that covers it also starts
in a row that comes before. Rows come in the order of their id; rows without an id come
last, in the order of a hash of their text, and equal texts among them have one place; rows of
one place do not repeat each other. What is found belongs to a row by its place and a second
hash of its text (``mark``), so rows of one id with different texts are kept apart.

1. *Anchors.* Every window has the k-word gram with the smallest hash as its anchor, so
   equal windows have equal anchors. An anchor that stands in two rows or more has a first
   row, and no row before that one can have any window with this anchor.
2. *Reference shards.* For each shared anchor, the first row's words around it belong to
   the reference; references are dealt into shards of bounded text by their row. Each
   shard's suffix automaton is built from its references in row order, so a state knows
   the first row of its words.
3. *Matching statistics.* All other rows with the anchor stream the words around it through
   that shard's automaton: wherever the longest match reaches ``min_words`` and the first
   row of the last ``min_words`` words comes before, the window is a repeat.
4. Windows that share an anchor with the first row but are not in it may still be in a row
   between. What did not match goes through steps 1-3 once more, with whole windows as
   anchors: then the first row with the anchor has the window.

All automata together are as large as the repeated text, which no executor can be shown to
hold; so a shard's automaton goes to the tasks that stream rows through it (one, or one
for every ``HOT_ROWS`` rows of a common anchor), not to all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from math import ceil
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, map_arrow, materialise, quoted, runs, slices, table, utf8

MIN_WORDS = 13
#: Words of an anchor in the first round.
GRAM = 4
#: Bytes of all text for one shard of references.
SHARD_BYTES = 1 << 20
#: Rows that share an anchor, for each copy of its references.
HOT_ROWS = 20_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    return x ^ (x >> np.uint64(29))


def anchors(texts: list[list[bytes]], gram: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, 48-bit hash) of the anchors of all windows of the texts, in order.

    All places that share a window's smallest hash are anchors. Words are hashed to 32 bits:
    anchors only say which words to compare.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    n = int(sizes.sum())
    spare = window - gram + 1  # grams in a window
    if n < window:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    h = np.fromiter((crc32(w) for t in texts for w in t), dtype=np.uint64, count=n)
    owner = np.repeat(np.arange(len(texts)), sizes)
    grams = np.zeros(n - gram + 1, dtype=np.uint64)
    for k in range(gram):
        grams = _mix(grams * _B + h[k: k + len(grams)] + np.uint64(1))
    grams >>= np.uint64(16)
    windows = n - window + 1
    least = grams[:windows].copy()
    for k in range(1, spare):
        np.minimum(least, grams[k: k + windows], out=least)
    inside = owner[:windows] == owner[window - 1:]
    least[~inside] = np.iinfo(np.uint64).max
    chosen = np.zeros(len(grams), dtype=bool)
    for k in range(spare):
        chosen[k: k + windows] |= grams[k: k + windows] == least
    at = np.flatnonzero(chosen)
    starts = np.cumsum(sizes) - sizes
    return owner[at], at - starts[owner[at]], grams[at].astype(np.int64)


class Automaton:
    """Suffix automaton of word sequences added in row order; a state knows its first row."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]

    def _state(self, following: dict, link: int, length: int, first: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.next) - 1

    def _extend(self, last: int, word: bytes, row: int) -> int:
        following, link, length = self.next, self.link, self.length
        to = following[last].get(word)
        if to is not None:
            if length[to] == length[last] + 1:
                return to
            return self._split(last, to, word)
        now = len(following)  # a new state, as by _state
        following.append({})
        link.append(0)
        length.append(length[last] + 1)
        self.first.append(row)
        p = last
        while p != -1 and word not in following[p]:
            following[p][word] = now
            p = link[p]
        if p != -1:
            q = following[p][word]
            link[now] = q if length[q] == length[p] + 1 else self._split(p, q, word)
        return now

    def _split(self, p: int, q: int, word: bytes) -> int:
        copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1, self.first[q])
        self.link[q] = copy
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list[bytes], row: int) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w, row)

    def repeats(self, words: list[bytes], row: int, window: int) -> list[int]:
        """Starts of the windows that stand in a row before ``row``."""
        following, link, length, first = self.next, self.link, self.length, self.first
        state = matched = 0
        found = []
        for end, w in enumerate(words, 1 - window):
            to = following[state].get(w)
            if to is None and state:
                while to is None and state:
                    state = link[state]
                    to = following[state].get(w)
                matched = length[state]
            if to is None:
                continue
            state, matched = to, matched + 1
            if matched > window:
                while length[link[state]] >= window:  # the state of the last ``window`` words
                    state = link[state]
                    matched = length[state]
            if matched >= window and first[state] < row:
                found.append(end)
        return found


def _spans(starts: np.ndarray) -> list[dict[str, int]]:
    """Runs of consecutive numbers as first and last."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return [{"lo": int(a), "hi": int(b)} for a, b in zip(starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)], strict=True)]


_SPANS = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
_RESTS = pa.list_(pa.struct([("begin", pa.int32()), ("words", pa.binary())]))


def _round(rows: DataFrame, gram: int, window: int, shards: int, name: str) -> DataFrame:
    """(ord long, mark long, begin int, words binary) -> (ord, mark, found spans of window starts, rest).

    ``words`` are joined by blanks; ``begin`` is the place of the first in its text; ``rest``
    has the word runs whose windows share an anchor with an earlier row but did not match.
    """
    margin = window - gram  # words of a window on one side of its anchor

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "words"):
                texts = [t.split() for t in utf8(part.column("words"))]
                owner, _, h = anchors(texts, gram, window)
                if len(h):
                    order = np.lexsort((h, owner))
                    keep = order[runs(owner[order], h[order])]
                    whose = pa.array(owner[keep])
                    yield pa.RecordBatch.from_arrays([pa.array(h[keep]), part.column("ord").take(whose), part.column("mark").take(whose)], names=["h", "ord", "mark"])

    # Anchors are counted with a partial aggregate and stored, so the join back has two plain
    # sides: adaptive execution splits an anchor that very many rows share.
    marked = map_arrow(rows.select("ord", "mark", "words"), mark, "h long, ord long, mark long")
    shared = (marked.groupBy("h").agg(F.min("ord").alias("first"), F.count("*").alias("n")).where("n > 1")
              .select("h", "first", F.ceil(F.log2(F.ceil(F.col("n") / HOT_ROWS))).cast("int").alias("heat")))
    shared = materialise(shared, f"{name}-shared")
    hits = marked.join(shared, "h").groupBy("ord", "mark").agg(F.collect_list(F.struct("h", "first", "heat")).alias("hits"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "words"):
                texts = [t.split() for t in utf8(part.column("words"))]
                owner, place, h = anchors(texts, gram, window)
                bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
                hits = part.column("hits")
                ords, marks, begins = (part.column(c).to_pylist() for c in ("ord", "mark", "begin"))
                out: list[tuple] = []
                for k, words in enumerate(texts):
                    lo, hi = bounds[k], bounds[k + 1]
                    here = hits[k].values
                    known = here.field("h").to_numpy()
                    order = np.argsort(known)
                    at = np.searchsorted(known[order], h[lo:hi])
                    ok = at < len(known)
                    ok[ok] = known[order[at[ok]]] == h[lo:hi][ok]
                    pick, p = order[at[ok]], place[lo:hi][ok]
                    if not len(p):
                        continue
                    first, heat = here.field("first").to_numpy()[pick], here.field("heat").to_numpy()[pick]
                    shard = (_mix(first.astype(np.uint64) + _B) % np.uint64(shards)).astype(np.int64)
                    own = first == ords[k]
                    # Runs of anchors for one shard whose words overlap; interleaved shards come apart.
                    order = np.lexsort((p, heat, own, shard))
                    p, shard, heat, own = p[order], shard[order], heat[order], own[order]
                    new = np.ones(len(p), dtype=bool)
                    new[1:] = (shard[1:] != shard[:-1]) | (own[1:] != own[:-1]) | (heat[1:] != heat[:-1]) | (p[1:] - p[:-1] > gram + 2 * margin)
                    starts = np.flatnonzero(new)
                    for a, b in zip(starts.tolist(), np.append(starts[1:], len(p)).tolist(), strict=True):
                        left, right = max(0, int(p[a]) - margin), min(len(words), int(p[b - 1]) + gram + margin)
                        copies = 1 << int(heat[a])
                        salts = range(copies) if own[a] else (crc32(str(ords[k]).encode()) % copies,)
                        some = b" ".join(words[left:right])
                        out += [(int(shard[a]), int(heat[a]), s, not own[a], ords[k], marks[k], begins[k] + left, some) for s in salts]
                if out:
                    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    names = ["shard", "heat", "salt", "streams", "ord", "mark", "begin", "words"]
    parts = map_arrow(rows.select("ord", "mark", "begin", "words").join(hits, ["ord", "mark"]), cut,
                      "shard long, heat int, salt int, streams boolean, ord long, mark long, begin int, words binary")
    dealt = parts.repartition("shard", "heat", "salt").sortWithinPartitions("shard", "heat", "salt", "streams", "ord", "begin")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, automaton = None, Automaton()
        for batch in batches:
            out: list[tuple] = []
            keys = zip(*(batch.column(c).to_pylist() for c in ("shard", "heat", "salt")), strict=True)
            for at, streams, row, its, begin, text in zip(keys, *(batch.column(c).to_pylist() for c in names[3:]), strict=True):
                if at != key:
                    key, automaton = at, Automaton()
                words = text.split()
                if not streams:
                    automaton.add(words, row)
                    continue
                found = np.array(automaton.repeats(words, row, window), dtype=np.int64)
                left = np.ones(max(0, len(words) - window + 1), dtype=bool)
                left[found] = False
                rest = [{"begin": begin + s["lo"], "words": b" ".join(words[s["lo"]: s["hi"] + window])} for s in _spans(np.flatnonzero(left))]
                out.append((row, its, _spans(found + begin), rest))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), _SPANS, _RESTS), strict=True)],
                                                 names=["ord", "mark", "found", "rest"])

    found = map_arrow(dealt, match, "ord long, mark long, found array<struct<lo int, hi int>>, rest array<struct<begin int, words binary>>")
    return materialise(found, name)


def row_order(key: Column, text: Column) -> Column:
    """The place of a row in the order of rows, as a long; ids must be below 2**61 in size."""
    late = F.lit(1 << 62) + F.abs(F.xxhash64(text) % F.lit((1 << 61) - 1))
    return F.coalesce(key.cast("bigint"), late)


def text_mark(text: Column) -> Column:
    """Tells the texts of one place in the order apart (another hash than that of the order)."""
    return F.xxhash64(F.lit(1), text)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(ord, mark, spans): for each row with repeats, the runs of repeated window starts."""
    rows = docs.select(row_order(quoted(id_col), quoted(text_col)).alias("ord"), text_mark(quoted(text_col)).alias("mark"), F.lit(0).alias("begin"), quoted(text_col).cast("binary").alias("words"))
    total = docs.agg(F.sum(F.octet_length(quoted(text_col)))).first()[0] or 0
    shards = max(1, ceil(total / SHARD_BYTES))
    first = _round(rows, min(GRAM, min_words), min_words, shards, "substring-first")
    rest = first.select("ord", "mark", F.explode("rest").alias("at")).select("ord", "mark", "at.begin", "at.words")
    second = _round(rest, min_words, min_words, shards, "substring-second")
    both = reduce(DataFrame.union, [x.where(F.size("found") > 0).select("ord", "mark", "found") for x in (first, second)])
    return both.groupBy("ord", "mark").agg(F.flatten(F.collect_list("found")).alias("spans"))


def _kept(words: list[bytes], spans: list[dict] | None, window: int) -> list[bytes]:
    if not spans:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for s in spans:
        edge[min(s["lo"], len(words))] += 1
        edge[min(s["hi"] + window, len(words))] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def _with_spans(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> tuple[DataFrame, str, str]:
    order, mark, spans = (fresh(docs.columns, c) for c in ("__ord", "__mark", "__spans"))
    found = repeated_spans(docs, id_col, text_col, min_words).select(F.col("ord").alias(order), F.col("mark").alias(mark), F.col("spans").alias(spans))
    placed = docs.withColumn(order, row_order(quoted(id_col), quoted(text_col))).withColumn(mark, text_mark(quoted(text_col)))
    return placed.join(found, [order, mark], "left"), order, spans


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the repeated words taken out of the texts that have some.

    The words that stay are joined by one blank; texts without a repeat (null and empty ones
    too) stay as they are; all rows and columns stay, a text may become empty. Rows of one id,
    equal or not, lose only words that rows of smaller ids have. One text's words must fit a task's memory.
    """
    marked, order, spans = _with_spans(docs, id_col, text_col, min_words)
    marked = marked.select(*[quoted(c) for c in docs.columns], spans)
    at = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                texts = part.column(text_col).to_pylist()
                for k, s in enumerate(part.column(spans).to_pylist()):
                    if s and texts[k] is not None:
                        texts[k] = b" ".join(_kept(texts[k].encode().split(), s, min_words)).decode()
                columns = part.columns[:-1]
                columns[at] = pa.array(texts, part.schema.field(text_col).type)
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names[:-1])

    return map_arrow(marked, work, docs.schema)


def removal_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Per row of ``docs``: the id, n_words, n_removed and the SHA-256 of the words that stay
    (joined by one blank). A null text has no words; an empty table gives no rows."""
    base = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    marked, _, spans = _with_spans(base, "id", "text", min_words)
    kind = base.schema["id"].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for t, s in zip(utf8(part.column("text")), part.column(spans).to_pylist(), strict=True):
                    words = t.split()
                    stay = _kept(words, s, min_words)
                    out.append((len(words), len(words) - len(stay), hashlib.sha256(b" ".join(stay)).hexdigest()))
                cols = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("id"), *cols], names=["id", "n_words", "n_removed", "kept_sha256"])

    schema = T.StructType([T.StructField("id", kind), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("kept_sha256", T.StringType())])
    return map_arrow(marked.select("id", "text", spans), work, schema).withColumnRenamed("id", id_col)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(table(spark, sf_dir, "documents"))
