"""Token-id output: one zstandard frame for each document, under a shared dictionary.

Ids are little-endian unsigned 32-bit integers, as the tokenizers library gives them without
adding special tokens; the string of a special token in a text is that token. A zstandard dictionary is trained on a
bounded sample of serialised id arrays; every document's ids are one frame of their own, so
any document can be read without its neighbours. Files are Parquet rows of blocks: first
document's id and token start, the dictionary's hash, the frames one after another, and an
index of ids, token starts and byte offsets. Blocks hold documents in ascending id order,
files are ranges of ids of about equal bytes; an id (or null) whose texts are larger than a file
is divided by a hash of the text. The dictionary is a file beside them, named by its hash.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..storage import scratch_path
from .common import map_arrow, quoted, slices, table
from .pieces import PieceMemo

END_ID = 0
LEVEL = 3
#: The dictionary is trained on the smallest id hashes: so many documents and bytes at most.
SAMPLE_ROWS, SAMPLE_BYTES, DICT_BYTES = 1024, 8 << 20, 64 << 10
#: Token bytes (before compression) of one output block and of one output file.
BLOCK_BYTES, FILE_BYTES = 4 << 20, 64 << 20
#: Quantiles of the ids for each file, joined by their bytes.
FINE = 8
_ENCODERS: dict[str, Encoder] = {}
_PATTERN = regex.compile(public_tokenizers.PATTERN)
#: Byte-level vocabularies write printable Latin-1 bytes as themselves, the others as the letters from 256 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_LETTERS = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_BLANK = _LETTERS[0x20]
#: Letters with one full stop or comma after them or none: the letters and the mark are matches of the pattern.
_PLAIN = re.compile("([ ]?[A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)").fullmatch
#: Rows that are encoded together: a word that they share is looked up once.
ENCODE_ROWS = 1024


class Encoder:
    """The tokenizers library's BPE model for whole texts, each different piece encoded once.

    The file's pre-tokenizer (byte level, with the vocabularies' pattern) is the split by that
    pattern and a letter for each byte; its model gets each different match once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        #: Strings that the library finds in a text before it splits it; none may be cut apart.
        self.added = [t["content"] for t in spec["added_tokens"]]
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.packed = [k.to_bytes(4, "little") for k in range(self.tokenizer.get_vocab_size())]
        self.byte_level = plain.items() <= (spec["pre_tokenizer"] or {}).items() and spec["normalizer"] is None and spec["model"]["type"] == "BPE"
        if any(c.isspace() for t in self.added for c in t) or any(t[k] for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word", "normalized")):
            raise ValueError("an added token of this vocabulary reaches over pieces of a text")
        self.memo = PieceMemo(self.encode_pieces)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        joined = "\n".join(pieces)
        added = [t for t in self.added if t in joined]
        whole = {p: b"" for p in pieces if not self.byte_level or any(t in p for t in added)} if added or not self.byte_level else {}
        for p, e in zip(whole, self.tokenizer.encode_batch_fast(list(whole), add_special_tokens=False), strict=True):
            whole[p] = np.array(e.ids, dtype="<u4").tobytes()
        tokenize, packed, known = self.tokenizer.model.tokenize, self.packed, {}
        found = []
        for p in pieces:
            if p in whole:
                found.append(whole[p])
            elif p.isascii() and p[:1] == " " and p[1:].isalpha():  # one match of the pattern
                found.append(b"".join([packed[t.id] for t in tokenize(_BLANK + p[1:])]))
            else:
                ids, plain = [], _PLAIN(p)
                for w in (plain.groups() if plain[2] else (p,)) if plain else _PATTERN.findall(p):
                    if w not in known:
                        letters = w.replace(" ", _BLANK) if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(_LETTERS)
                        known[w] = b"".join([packed[t.id] for t in tokenize(letters)])
                    ids.append(known[w])
                found.append(b"".join(ids))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        return self.memo.encode(texts)


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_ids(texts: pa.Array, path: str, end_id: int) -> list[bytes]:
    """Each text's ids and the end id as bytes; a null text has no other id."""
    tail = np.array([end_id], dtype="<u4").tobytes()
    return [b + tail for b in encoder(path).encode([t or "" for t in texts.to_pylist()])]


def train_dictionary(docs: DataFrame, path: str) -> bytes:
    """A dictionary from a sample of bounded rows and bytes; empty if the sample is too small."""
    sample = (docs.where(F.octet_length("text") <= SAMPLE_BYTES // SAMPLE_ROWS * 2).select("id").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([pa.array(encode_ids(part.column("text"), path, END_ID), pa.binary())], names=["ids"])

    rows = map_arrow(docs.join(F.broadcast(sample.distinct()), "id").select("text"), work, "ids binary")
    samples = [bytes(r["ids"]) for r in rows.where(F.octet_length("ids") <= SAMPLE_BYTES // SAMPLE_ROWS * 4).orderBy(F.xxhash64("ids")).limit(SAMPLE_ROWS).collect()]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, level=LEVEL).as_bytes() if len(samples) > 8 else b""
    except zstandard.ZstdError:  # too few or too uniform samples
        return b""


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


@dataclass(frozen=True)
class Ranges:
    """File ranges in id order: segment ``k`` begins at id ``lows[k - 1]`` (segment 0 below all) and
    its rows go to ``width[k]`` ranges from ``first[k]`` on; null ids come before all, in the first
    ``nulls`` ranges, or in range 0 with the ids after them."""

    lows: np.ndarray
    first: np.ndarray
    width: np.ndarray
    nulls: int

    @property
    def count(self) -> int:
        return int(self.first[-1] + self.width[-1])

    def of(self, ids: pa.Array, texts: pa.Array) -> list[int]:
        segment = np.searchsorted(self.lows, pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), side="right")
        first, width = self.first[segment], self.width[segment]
        if ids.null_count:
            none = ids.is_null().to_numpy(zero_copy_only=False)
            first, width = np.where(none, 0, first), np.where(none, max(1, self.nulls), width)
        found = first.copy()
        for k in np.flatnonzero(width > 1).tolist():
            found[k] += xxhash.xxh64_intdigest(texts[k].as_py() or "") % int(width[k])
        return found.tolist()


def pack_segments(lows: list[int], size: Mapping[int, int], null_size: int, file_bytes: int) -> Ranges:
    """Join neighbouring segments up to ``file_bytes`` and divide larger ones that are a single id.

    ``size`` holds the bytes of segment numbers (see ``Ranges``).
    """
    nulls = -(-null_size // file_bytes) if null_size > file_bytes else 0
    kept, first, width, at, held = [], [], [], nulls, 0 if nulls else null_size
    alone = False
    for k in range(len(lows) + 1):
        n = size.get(k, 0)
        single = 0 < k < len(lows) and lows[k] == lows[k - 1] + 1
        heavy = single and n > file_bytes
        if first and not heavy and not alone and held + n <= file_bytes:
            held += n
            continue
        if first:
            at += width[-1]
            kept.append(lows[k - 1])
        first.append(at)
        width.append(-(-n // file_bytes) if heavy else 1)
        held, alone = n + (held if not first[:-1] else 0), heavy
    return Ranges(np.array(kept, dtype=np.int64), np.array(first, dtype=np.int64), np.array(width, dtype=np.int64), nulls)


def _segments(batch: pa.RecordBatch, lows: np.ndarray) -> np.ndarray:
    """Each row's segment by its id, -1 for null."""
    ids = batch.column("id")
    found = np.searchsorted(lows, pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), side="right")
    return np.where(ids.is_null().to_numpy(zero_copy_only=False), -1, found)


def _in_segments(batches: Iterator[pa.RecordBatch], ends: np.ndarray, wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(np.isin(_segments(batch, ends), wanted)))


def segment_bytes(sized: DataFrame, lows: list[int]) -> dict[int, int]:
    """Bytes of each segment between ``lows`` that has any (-1: null ids)."""
    bounds = np.array(lows, dtype=np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(bounds) + 2, dtype=np.int64)
        for batch in batches:
            np.add.at(sums, _segments(batch, bounds) + 1, batch.column("n").to_numpy())
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at - 1, pa.int64()), pa.array(sums[at], pa.int64())], names=["segment", "n"])

    parts = map_arrow(sized, count, "segment long, n long")
    return {r["segment"]: r["n"] for r in parts.groupBy("segment").agg(F.sum("n").alias("n")).collect()}


def file_ranges(base: DataFrame, file_bytes: int) -> Ranges:
    """Ranges of ``base`` (id, text) of about ``file_bytes`` of text, from the bytes of all rows.

    The driver gets some numbers for each file: quantiles of the ids, ids of more than a file, and
    the bytes between them.
    """
    sized = base.select("id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n"))
    total = sized.agg(F.sum("n")).first()[0] or 0
    files = -(-total // file_bytes)
    if files <= 1:
        return pack_segments([], {}, 0, file_bytes)
    fine = FINE * files
    cuts = set(map(int, base.stat.approxQuantile("id", [k / fine for k in range(1, fine)], 0.2 / fine)))
    lows = sorted(cuts)
    size = segment_bytes(sized, lows)
    large = [k for k, n in size.items() if n > file_bytes and k >= 0]
    if large:  # these may hold an id of more than a file; there are fewer of them than files
        ends = np.array(lows, dtype=np.int64)
        inside = map_arrow(sized, partial(_in_segments, ends=ends, wanted=np.array(large)), "id long, n long")
        heavy = [r["id"] for r in inside.groupBy("id").agg(F.sum("n").alias("n")).where(F.col("n") > file_bytes).collect()]
        lows = sorted({*lows, *heavy, *(i + 1 for i in heavy if i < 2**63 - 1)})
        size = segment_bytes(sized, lows) if heavy else size
    return pack_segments(lows, size, size.pop(-1, 0), file_bytes)


BLOCK_SCHEMA = ("range int, first_start long, dict_hash string, ids array<long>, starts array<long>, "
                "offsets array<long>, frames binary")


def write_tokens(docs: DataFrame, path: str, out: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> None:
    """Encode, compress and write all rows of ``docs`` under ``out`` (``blocks`` and ``dictionary``).

    Rows are in ascending id order, null ids first, rows of one id in an order that follows from
    their texts. An empty table gives no blocks. One document's ids must fit a task's memory.
    """
    base = docs.select(quoted(id_col).cast("bigint").alias("id"), quoted(text_col).alias("text"))
    raw = train_dictionary(base, path)
    digest = hashlib.sha256(raw).hexdigest()
    spark = docs.sparkSession
    spark.createDataFrame([(digest, bytearray(raw))], "hash string, dictionary binary").coalesce(1).write.parquet(f"{out}/dictionary")
    shared = spark.sparkContext.broadcast(raw)  # DICT_BYTES at most
    ranges = file_ranges(base, FILE_BYTES // 2)  # a token has four bytes, and about two bytes of text
    bounds = spark.sparkContext.broadcast(ranges)  # some numbers for each file

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared.value))
        for batch in batches:
            for part in slices(batch, "text", ENCODE_ROWS):
                ids = encode_ids(part.column("text"), path, end_id)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bounds.value.of(part.column("id"), part.column("text")), pa.int32()), part.column("id"),
                     pa.array([len(b) // 4 for b in ids], pa.int64()), pa.array(map(packer.compress, ids), pa.binary())],
                    names=["range", "id", "n", "frame"])

    packed = map_arrow(base, squeeze, "range int, id long, n long, frame binary")
    ranged = packed.repartitionById(ranges.count, "range").sortWithinPartitions("range", "id", "n", "frame")

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = start = 0

        def flush() -> pa.RecordBatch:
            lengths = np.array([n for _, _, n, _ in held], dtype=np.int64)
            ends = np.cumsum([len(f) for *_, f in held])
            row = {"range": held[0][0], "first_start": start - int(lengths.sum()), "dict_hash": digest, "ids": [i for _, i, _, _ in held],
                   "starts": np.append(0, np.cumsum(lengths)).tolist(), "offsets": np.append(0, ends).tolist(), "frames": b"".join(f for *_, f in held)}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("range", pa.int32()), ("first_start", pa.int64()), ("dict_hash", pa.string()), ("ids", pa.list_(pa.int64())),
                ("starts", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("frames", pa.binary())]))

        for batch in batches:
            for r, i, n, f in zip(*(batch.column(c).to_pylist() for c in ("range", "id", "n", "frame")), strict=True):
                held.append((r, i, n, f))
                size += 4 * n
                start += n
                if size >= BLOCK_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    map_arrow(ranged.select("range", "id", "n", "frame"), block, BLOCK_SCHEMA).write.parquet(f"{out}/blocks")


def read_blocks(spark: SparkSession, out: str) -> tuple[DataFrame, dict[int, int], dict[str, bytes]]:
    """Blocks, the token start of each range (one number for each file) and the dictionaries by hash."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{out}/blocks")
    dictionaries = {r["hash"]: bytes(r["dictionary"]) for r in spark.read.parquet(f"{out}/dictionary").collect()}
    for h, raw in dictionaries.items():
        if hashlib.sha256(raw).hexdigest() != h:
            raise ValueError("a token dictionary does not match its hash")
    counts = blocks.groupBy("range").agg(F.sum(F.element_at("starts", -1)).alias("n")).orderBy("range").collect()
    begin, starts = 0, {}
    for r in counts:
        starts[r["range"]] = begin
        begin += r["n"]
    return blocks, starts, dictionaries


def unpack(row: dict, raw: bytes, k: int | None = None) -> Iterator[tuple[int, int, bytes]]:
    """(id, start in the block, id bytes) of a block's documents, or of its ``k``-th alone."""
    reader = zstandard.ZstdDecompressor(dict_data=_dictionary(raw))
    frames, offsets = memoryview(row["frames"]), row["offsets"]
    for j in range(len(row["ids"])) if k is None else (k,):
        yield row["ids"][j], row["starts"][j], reader.decompress(frames[offsets[j]: offsets[j + 1]])


def lookup(spark: SparkSession, out: str, doc_id: int) -> list[list[int]]:
    """The ids of one document (of each row with that id), reading only its frames."""
    blocks, _, dictionaries = read_blocks(spark, out)
    found = []
    for r in blocks.where(F.array_contains("ids", doc_id)).collect():  # a block for each row of the id, at most
        row = r.asDict()
        hi = bisect_right(row["ids"], doc_id) if None not in row["ids"] else len(row["ids"])
        found += [np.frombuffer(b, dtype="<u4").tolist() for j in range(hi) if row["ids"][j] == doc_id for _, _, b in unpack(row, dictionaries[row["dict_hash"]], j)]
    return found


def read_digests(spark: SparkSession, out: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the files."""
    blocks, starts, dictionaries = read_blocks(spark, out)
    shared = spark.sparkContext.broadcast((starts, dictionaries))  # a number for each file, and the dictionaries

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins, raws = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                base = begins[row["range"]] + row["first_start"]
                docs = [(i, base + s, len(b) // 4, zlib.crc32(b)) for i, s, b in unpack(row, raws[row["dict_hash"]])]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*docs, strict=True)], names=["id", "start", "n_tokens", "ids_crc32"])

    return map_arrow(blocks, work, "id long, start long, n_tokens long, ids_crc32 long")


def op6_token_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), out)
    return read_digests(spark, out).select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")
