"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL.

Every text is two word streams, the lower-cased words and their shapes (case class, the
characters after the last letter or digit, whether the word repeats the one before); the
features are the hashed 1- and 2-grams of both. A text's features are their relative
frequencies times ``SCALE``, so a score is one sparse dot product over the text's n-grams.
Training follows the regularised leader (McMahan et al., 2013) over a bounded sample of
labelled texts, streamed through one task; the model is one float vector of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, map_arrow, quoted, slices, table, utf8

BITS = 18
SCALE = 16.0
#: Training uses at most so many labelled texts (those with the smallest hash of their id).
MAX_TRAINING_ROWS = 8192
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-3
ACCEPT = 0.7
#: Hashed words that one task remembers.
MEMO_WORDS = 60_000
HELD_OUT = 2

_ALNUM = bytes(b for b in range(256) if b >= 0x80 or chr(b).isalnum())
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _shape(word: bytes) -> bytes:
    tail = word.lstrip(_ALNUM)
    if len(word) - len(tail) > 1 and word.isupper():
        return b"A" + tail
    return (b"a" if word[:1].islower() else b"1" if word[:1].isdigit() else b"w") + tail


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def ngram_ids(text: bytes, memo: dict[bytes, tuple[int, int]], bits: int = BITS) -> np.ndarray:
    """The hashed features of one text, one for each n-gram place; empty if it has no word.

    ``memo`` keeps the hashes of words seen before; it is emptied when it grows large.
    """
    words = text.split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    if len(memo) > MEMO_WORDS:
        memo.clear()
    pairs = []
    for w in words:
        p = memo.get(w)
        if p is None:
            p = memo[w] = (xxhash.xxh64_intdigest(w.lower(), 1), xxhash.xxh64_intdigest(_shape(w), 2))
        pairs.append(p)
    both = np.array(pairs, dtype=np.uint64)
    word, shape = both[:, 0], both[:, 1]
    same = np.zeros(len(word), dtype=np.uint64)
    same[1:] = word[1:] == word[:-1]
    shape = _spread(shape + same * np.uint64(0x632BE59BD9B4E019))
    grams = [word, _spread(word[:-1] * _MIX + word[1:]), shape, _spread(shape[:-1] * _MIX + shape[1:] + np.uint64(7))]
    return (_spread(np.concatenate(grams)) >> np.uint64(64 - bits)).astype(np.int64)


class Ftrl:
    """FTRL-proximal logistic regression; the last coordinate is the intercept."""

    def __init__(self, bits: int = BITS):
        self.z = np.zeros((1 << bits) + 1)
        self.n = np.zeros((1 << bits) + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) > L1, w, 0.0)

    def learn(self, ids: np.ndarray, label: int) -> None:
        at, count = np.unique(ids, return_counts=True)
        at = np.append(at, len(self.z) - 1)
        x = np.append(count * (SCALE / max(len(ids), 1)), 1.0)
        w = self.weights(at)
        g = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - step * w
        self.n[at] += g * g


@dataclass(frozen=True)
class Model:
    weights: bytes | None  # float32, 2**bits coordinates and the intercept; None if never trained
    bits: int = BITS

    @property
    def trained(self) -> bool:
        return self.weights is not None


def is_held_out(key: Column) -> Column:
    """Rows never trained on: crc32 of the id as text leaves 2 on division by 4; null: false."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_rows: int = MAX_TRAINING_ROWS, epochs: int = EPOCHS, bits: int = BITS) -> Model:
    """Fit the model to labelled texts outside the held-out fold.

    Ids with a null label or contradicting labels are left out. Each id stands for one of its
    texts, that with the smallest hash, so the sample is bounded however often an id repeats.
    Without any labelled text the model is untrained.
    """
    key = quoted(id_col)
    sample = (labels.where(key.isNotNull() & ~is_held_out(key)).groupBy(key.alias("id"))
              .agg(F.min(quoted(label_col)).alias("label"), F.max(quoted(label_col)).alias("high"))
              .where("label = high AND label IN (0, 1)").select("id", F.col("label").cast("int").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(max_rows))
    texts = docs.select(key.alias("id"), quoted(text_col).alias("text")).join(F.broadcast(sample), "id")  # at most max_rows ids
    rows = texts.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [ngram_ids(t, memo, bits).astype(np.int32) for t in utf8(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), pa.array(ids, pa.list_(pa.int32()))],
                                                 names=["id", "label", "grams"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = Ftrl(bits), 0
        for batch in batches:
            grams = batch.column("grams")
            for k, label in enumerate(batch.column("label").to_pylist()):
                model.learn(grams[k].values.to_numpy(), label)
                seen += 1
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([model.weights().astype(np.float32).tobytes()], pa.binary())], names=["weights"])

    grams = map_arrow(rows, hashed, "id " + dict(rows.dtypes)["id"] + ", label int, grams array<int>")
    passes = grams.withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(epochs)])))
    ordered = passes.repartition(1).sortWithinPartitions("epoch", F.xxhash64("id", "epoch"), "id")
    found = map_arrow(ordered.select("label", "grams"), learn, "weights binary").collect()  # one row of fixed size
    return Model(bytes(found[0]["weights"]) if found else None, bits)


def add_score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the double ``out`` from 0 to 1; null counts as empty; untrained: 0.5.

    A column of that name is replaced; all other columns and every row, repeated or not, stay.
    """
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # about 1 MB

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value.bits
        w = np.frombuffer(shared.value.weights, dtype=np.float32) if shared.value.trained else np.zeros((1 << bits) + 1, np.float32)
        memo: dict = {}
        for batch in batches:
            for part in slices(batch, text_col):
                dots = []
                for t in utf8(part.column(text_col)):
                    ids = ngram_ids(t, memo, bits)
                    dots.append(w[ids].sum(dtype=np.float64) * SCALE / len(ids) if len(ids) else 0.0)
                p = 1.0 / (1.0 + np.exp(-np.clip(np.array(dots) + float(w[-1]), -35, 35)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p, pa.float64())], names=[*part.schema.names, out])

    return map_arrow(docs, work, schema)


def drop_low_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     label_col: str = "quality", accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts; all of them if no label could be learnt.

    A null text is scored as an empty one, equal texts get equal scores, repeated rows stay
    or go together, a score of exactly ``accept`` stays; all columns are kept, whatever their names.
    """
    model = train(docs, labels, id_col, text_col, label_col)
    if not model.trained:
        return docs
    score = fresh(docs.columns, "__score")
    return add_score(docs, model, text_col, score).where(quoted(score) >= accept).select(*[quoted(c) for c in docs.columns])


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = add_score(docs, model).select("doc_id", "score")
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
