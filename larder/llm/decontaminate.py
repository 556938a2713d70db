"""Benchmark decontamination: passages against a BM25 index of test items.

Every text is cut into overlapping passages and each passage is a query: which test items
score at least ``threshold`` of their own score (BM25 of the item against itself)? Block-max
WAND (Ding and Suel, 2011) moves a cursor over the posting list of each word of the query and
finds all items above the threshold. Found items are verified: enough of the word n-grams of
both the question and the answer must stand in the passage. An item is its text: its last
sentence is the answer, what comes before is the question (one sentence: its two halves).

Items are kept by their length in powers of two, each class with passages of twice its
longest length; what is found of an item does not depend on the lengths of others. Items of
equal text are one item of the index. The index holds about ``INDEX_BYTES`` of item text; more
items are searched in rounds, one after another, with word statistics over all items.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain, repeat
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, map_arrow, materialise, quoted, runs, slices, table

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.5
NGRAM = 3
#: Items of so many words or fewer are one class, the next classes reach twice as far each.
CLASS_WORDS = 64
BLOCK = 4
#: Passages that are searched side by side.
QUERIES = 1024
INDEX_BYTES = 16 << 20

_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() or b == 0x20 else 0x20 for b in range(256))


def words(text: str) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and digits and of characters beyond ASCII."""
    return text.lower().encode().translate(_FOLD).split()


def question_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The words of an item's question and answer."""
    sentences = [w for s in re.split(r"(?<=[.!?])\s+|\n+", text) if (w := words(s))]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    whole = sentences[0] if sentences else []
    return whole[: (len(whole) + 1) // 2], whole[(len(whole) + 1) // 2:]


def _grams(seq: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return {tuple(seq[k: k + n]) for k in range(len(seq) - n + 1)}


class Index:
    """Posting lists of test items of one length class, with contributions relative to each
    item's own score. Every list ends with a posting of no item that lies behind all others."""

    def __init__(self, items: list[tuple[str, str]], df: dict[bytes, int], n_items: int, mean_words: float, longest: int = CLASS_WORDS):
        self.length, self.keys, self.parts, lists = 2 * longest, [], [], defaultdict(list)
        for key, text in items:
            tf = Counter(words(text))
            size = sum(tf.values())
            part = {t: log(1 + (n_items - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * size / mean_words)) for t, c in tf.items()}
            own = sum(part.values())
            for t, x in part.items():
                lists[t].append((len(self.keys), x / own))
            self.keys.append(key)
            self.parts.append([(n, _grams(p, n)) for p in question_answer(text) for n in (min(NGRAM, len(p)),) if n])
        self.n = len(self.keys)
        self.term = {t: k for k, t in enumerate(lists)}
        self.most = np.array([max(x for _, x in lists[t]) for t in self.term] + [0.0])  # the last one: words of no item
        flat = [(k, d, x) for k, t in enumerate(self.term) for d, x in (*lists[t], (self.n, 0.0))] + [(len(lists), self.n, 0.0)]
        term, self.item, self.gain = (np.array(c) for c in zip(*flat, strict=True))
        self.key = term * (self.n + 1) + self.item  # ascending: by word, then item
        self.start = np.searchsorted(term, np.arange(len(self.most)))
        cut = runs(term, self.item // BLOCK)
        size = np.diff(np.append(cut, len(term)))
        self.block_max = np.repeat(np.maximum.reduceat(self.gain, cut), size)  # of the posting's block in its list
        self.after = np.minimum(np.repeat(cut + size, size), np.append(self.start[1:], len(term))[term] - 1)  # the list's next block

    def search(self, terms: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Block-max WAND for several queries at once: (query, item, score) of all items that
        score ``threshold`` or more. A row of ``terms`` is a query: different words, filled up
        with the word of no item.

        One step of a query: its cursors stand in the order of their items, and the first at
        which the lists' largest gains add up to the threshold marks the pivot. No item before it
        can reach the threshold, so the cursors before move to it. Do the largest gains of the
        blocks they stand in reach the threshold too, the pivot is scored; else the cursors skip
        to the end of the block or to the next cursor's item, whichever comes first.
        """
        floor, found = threshold - 1e-9, []
        most = self.most[terms]
        query = np.flatnonzero(most.sum(axis=1) >= floor)
        terms, most = terms[query], most[query]
        at = self.start[terms]
        while len(query):
            item = self.item[at]
            most[item == self.n] = 0.0  # lists at their end
            order = np.argsort(item, axis=1)
            lines = np.arange(len(query))
            reach = np.cumsum(most[lines[:, None], order], axis=1) >= floor
            go = reach[:, -1]
            left = np.count_nonzero(go)
            if 4 * left < 3 * len(go):  # queries without a pivot are done
                query, terms, most, at = (x[go] for x in (query, terms, most, at))
                if left:
                    continue
                break
            pivot = np.where(go, item[lines, order[lines, np.argmax(reach, axis=1)]], -1)
            ahead = item > pivot[:, None]
            cell = np.flatnonzero(~ahead)
            row = cell // at.shape[1]
            to, here, term = at.ravel()[cell], pivot[row], terms.ravel()[cell] * (self.n + 1)
            late = np.flatnonzero(item.ravel()[cell] < here)
            to[late] = np.searchsorted(self.key, term[late] + here[late])
            there, end = self.item[to], np.minimum((pivot // BLOCK + 1) * BLOCK, self.n)
            bound = np.bincount(row, self.block_max[to] * (there < end[row]), len(query)) >= floor
            on = bound[row] & (there == here)
            if on.any():
                score = np.bincount(row[on], self.gain[to[on]], len(query))
                hit = np.flatnonzero(bound & (score >= floor))
                found.append((query[hit], pivot[hit], score[hit]))
                to += on  # past the pivot that was scored
            target = np.where(bound, 0, np.minimum(np.where(ahead, item, self.n).min(axis=1), end))
            skip = np.flatnonzero(there < target[row])
            whole = target[row[skip]] == end[row[skip]]
            to[skip[whole]] = self.after[to[skip[whole]]]
            part = skip[~whole]
            to[part] = np.searchsorted(self.key, term[part] + target[row[part]])
            at.ravel()[cell] = to
        if not found:
            return (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0),)
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def overlaps(self, item: int, passage: list[bytes]) -> tuple[float, float]:
        """Shares of the question's and the answer's n-grams in the passage."""
        shares = [len(grams & _grams(passage, n)) / len(grams) for n, grams in self.parts[item]]
        return shares[0], shares[-1]

    def leaks(self, texts: list[list[bytes]], threshold: float, overlap: float) -> dict[tuple[int, str], tuple[int, float, float, float]]:
        """(text, item) -> (first word of its best passage, score, question share, answer share)."""
        none, length, step = len(self.term), self.length, self.length // 2
        spots = [(k, b) for k, seq in enumerate(texts) for b in range(0, max(1, len(seq) - length + step), step) if seq]
        flat = np.fromiter(map(self.term.get, chain.from_iterable(texts), repeat(none)), dtype=np.int64)
        ends = np.cumsum([len(seq) for seq in texts])
        out: dict[tuple[int, str], tuple[int, float, float, float]] = {}
        for lo in range(0, len(spots), QUERIES):
            some = np.array(spots[lo: lo + QUERIES])
            till = ends[some[:, 0]]
            begin = till - np.array([len(texts[k]) for k in some[:, 0]]) + some[:, 1]
            places = begin[:, None] + np.arange(length)
            terms = np.where(places < till[:, None], flat[np.minimum(places, len(flat) - 1)], none)
            terms.sort(axis=1)
            terms[:, 1:][terms[:, 1:] == terms[:, :-1]] = none
            terms.sort(axis=1)
            wide = int((terms < none).sum(axis=1).max())
            for q, item, score in sorted(zip(*(c.tolist() for c in self.search(terms[:, :wide], threshold)), strict=True)):
                k, b = spots[lo + q]
                at = (k, self.keys[item])
                if at in out and out[at][1] >= score:
                    continue
                question, answer = self.overlaps(item, texts[k][b: b + length])
                if question >= overlap and answer >= overlap:
                    out[at] = (b, score, question, answer)
        return out


def _leaks(indexes: list[Index], texts: list[str | None], threshold: float, overlap: float) -> dict[tuple[int, str], tuple[int, float, float, float]]:
    seqs = [words(t or "") for t in texts]
    return {at: hit for index in indexes for at, hit in index.leaks(seqs, threshold, overlap).items()}


def _item_key(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def build_indexes(items: DataFrame, text_col: str = "text", index_bytes: int = INDEX_BYTES) -> Iterator[list[Index]]:
    """Rounds of bounded size that cover all different item texts, each with an index for every
    length class; items without a word are in none."""
    text = quoted(text_col)
    base = items.where(text.isNotNull()).select(text.alias("text")).distinct()
    rounds = ceil((base.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / index_bytes)
    if not rounds:
        return

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        n = size = 0
        for batch in batches:
            for t in batch.column("text").to_pylist():
                w = words(t)
                n, size = n + bool(w), size + len(w)
                df.update(set(w))
        df[b""] = n  # no word: the items
        df[b" "] = size  # and the words of all
        yield pa.RecordBatch.from_arrays([pa.array(list(df), pa.binary()), pa.array(list(df.values()), pa.int64())], names=["word", "n"])

    counts = map_arrow(base, count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    if rounds > 1:
        counts = materialise(counts, "decontaminate-words")
    total = {bytes(r["word"]): r["n"] for r in counts.where("word IN (X'', X'20')").collect()}
    if not total.get(b""):
        return
    for k in range(rounds):
        rows = base.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == k).select(_item_key(F.col("text")).alias("key"), "text").collect()  # index_bytes or so
        classes = defaultdict(list)
        vocabulary: set[bytes] = set()
        for r in sorted(rows):
            if w := words(r["text"]):
                classes[CLASS_WORDS << max(0, (len(w) - 1) // CLASS_WORDS).bit_length()].append((r["key"], r["text"]))
                vocabulary.update(w)
        if rounds == 1:
            df = {bytes(r["word"]): r["n"] for r in counts.collect()}
        else:
            mine = items.sparkSession.createDataFrame([(bytearray(w),) for w in vocabulary], "word binary")
            df = {bytes(r["word"]): r["n"] for r in counts.join(mine, "word", "left_semi").collect()}
        yield [Index(classes[c], df, total[b""], total[b" "] / total[b""], c) for c in sorted(classes)]


def _rounds(items: DataFrame, text_col: str) -> Iterator[tuple[Broadcast, bool]]:
    """Each round's indexes, broadcast, and whether it is the last one."""
    spark, rounds = items.sparkSession, build_indexes(items, text_col)
    now = next(rounds, None)
    while now is not None:
        later = next(rounds, None)
        yield spark.sparkContext.broadcast(now), later is None
        now = later


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """(id, item, first_word, score, question_overlap, answer_overlap): one row for each row of
    ``docs`` and item found in it, with the passage of the best score.

    Null and empty texts hold no item; repeated rows and repeated items are all reported, ties
    between passages go to the first; without items there are no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    base = docs.select(quoted(id_col).alias(id_col), quoted(text_col).alias("text"))
    key = fresh([id_col], "__item")
    measures = [T.StructField("first_word", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in ("score", "question_overlap", "answer_overlap")]]
    schema = T.StructType([docs.schema[id_col], T.StructField(key, T.StringType()), *measures])
    names = schema.names

    def search(shared) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            indexes = shared.value
            for batch in batches:
                for part in slices(batch, "text"):
                    found = sorted(_leaks(indexes, part.column("text").to_pylist(), threshold, overlap).items())
                    if found:
                        hits = zip(*((item, *hit) for (_, item), hit in found), strict=True)
                        kinds = (pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                        yield pa.RecordBatch.from_arrays([part.column(id_col).take(pa.array([k for (k, _), _ in found])),
                                                          *(pa.array(c, t) for c, t in zip(hits, kinds, strict=True))], names=names)
        return map_arrow(base, work, schema)

    found = None
    for shared, last in _rounds(items, item_text_col):
        now = search(shared)
        if not last or found is not None:  # several rounds: each is written before the next index is sent
            now = materialise(now, "decontaminate-found")
            shared.unpersist()
        found = now if found is None else found.union(now)
    if found is None:
        found = spark.createDataFrame([], schema)
    owners = items.where(quoted(item_text_col).isNotNull()).select(_item_key(quoted(item_text_col)).alias(key), quoted(item_col).alias("item_id"))
    return found.join(owners, key).select(found[id_col], owners["item_id"], *[found[f.name] for f in measures])


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``docs`` that hold no test item; all columns stay, whatever their names.

    Null and empty texts hold none and stay, equal rows stay or go together, a share of exactly
    ``overlap`` is a leak; without items, or with items that have no word, all rows stay.
    """
    rounds = 0
    for shared, last in _rounds(items, item_text_col):
        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, text_col):
                    found = {k for k, _ in _leaks(shared.value, part.column(text_col).to_pylist(), threshold, overlap)}
                    yield part.filter(pa.array([k not in found for k in range(part.num_rows)]))

        docs = map_arrow(docs, work, docs.schema)
        rounds += 1
        if not last or rounds > 1:
            docs = materialise(docs, "decontaminate-kept")
            shared.unpersist()
    return docs


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
