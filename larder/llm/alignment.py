"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes of a text.

A is a byte-level BPE of the tokenizers library, B a sentencepiece model; both see a blank and the
text. The tokens of a text are the rows of a token-byte incidence matrix in CSR form, with a one
for every byte that a token covers.

- *Overlap links* are the entries of A B^T (Gustavson's row products): tokens that share bytes,
  with their number.
- *Groups* are read off that product: where the next A token shares no B token with the one
  before, tokens of both sides end, and a group does.
- *Shared-group links* are the products of group incidence matrices: rows for the ids of A, columns
  for the groups, the number of tokens as values, times the same of B transposed, give for every
  pair of ids how many pairs of token occurrences share a group, without listing them.

Both vocabularies never join a blank or line end to a character before it other than white space,
so texts are cut there, each different piece is aligned once, and texts add up their pieces (again
a product, of texts by pieces and pieces by id pairs).

A pair's count is the number of documents that hold it linked, over the whole corpus. Tasks put
out *chunks*: the documents of some megabytes of text, with the chunk's different pairs and how
many of its documents hold them. Pairs are counted over all chunks, and each chunk gets the counts
of its own pairs back: what is shuffled are pairs of chunks, not links of documents.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import map_arrow, materialise, quoted, runs, slices, table, without_gc
from .pieces import PIECE

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Text bytes of a chunk, unless one text is longer.
CHUNK_BYTES = 16 << 20
#: Pieces that one Python worker remembers.
MEMO_ROWS = 400_000
#: Pieces that are aligned, and piece places that are added up, at a time.
STEP_PIECES, STEP_PLACES = 20_000, 200_000
_ALIGNERS: dict[tuple, Aligner] = {}
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Byte-level vocabularies write each byte as a letter: printable Latin-1 as itself, others from 256 on.
_LETTERS = {b: chr(b) for b in _PRINTED} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_BLANK = _LETTERS[0x20]


@dataclass
class CSR:
    """A sparse matrix by rows: row i holds columns ``indices[indptr[i]:indptr[i + 1]]`` with ``data``."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    @property
    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self) -> CSR:
        order = np.argsort(self.indices, kind="stable")
        counts = np.bincount(self.indices, minlength=self.columns)
        return CSR(np.append(0, np.cumsum(counts)), self.rows[order], self.data[order], len(self.indptr) - 1)


def from_entries(row: np.ndarray, column: np.ndarray, data: np.ndarray, rows: int, columns: int) -> CSR:
    """The matrix with the sums of the given entries."""
    key = row.astype(np.int64) * columns + column
    if len(key) and not (key[1:] >= key[:-1]).all():
        order = np.argsort(key, kind="stable")
        key, data = key[order], data[order]
    at = runs(key)
    data = np.add.reduceat(data, at) if len(at) else data[:0]
    row, column = np.divmod(key[at], max(1, columns))
    return CSR(np.append(0, np.cumsum(np.bincount(row, minlength=rows))), column, data, columns)


def product(a: CSR, b: CSR) -> CSR:
    """a times b by Gustavson's row products: row i is the sum of b's rows k, times a[i, k]."""
    begin, width = b.indptr[a.indices], b.indptr[a.indices + 1] - b.indptr[a.indices]
    at = np.arange(int(width.sum())) + np.repeat(begin - (np.cumsum(width) - width), width)
    return from_entries(np.repeat(a.rows, width), b.indices[at], np.repeat(a.data, width) * b.data[at], len(a.indptr) - 1, b.columns)


def incidence(lengths: np.ndarray) -> CSR:
    """Tokens by bytes, for tokens of the given lengths one after another."""
    total = int(lengths.sum())
    return CSR(np.append(0, np.cumsum(lengths)), np.arange(total), np.ones(total, dtype=np.int64), total)


def overlaps(a: np.ndarray, b: np.ndarray) -> CSR:
    """A tokens by B tokens: shared bytes, for token lengths that cover the same bytes."""
    return product(incidence(a), incidence(b).transposed())


def groups(shared: CSR, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A token and each B token, from their overlaps."""
    first, last = shared.indices[shared.indptr[:-1]], shared.indices[shared.indptr[1:] - 1]
    new = np.ones(len(first), dtype=bool)
    new[1:] = first[1:] != last[:-1]
    of_a = np.cumsum(new) - 1
    of_b = np.zeros(n_b, dtype=np.int64)
    of_b[shared.indices] = of_a[shared.rows]
    return of_a, of_b


def _letters_to_bytes(token: str, back: dict[str, int]) -> bytes:
    return bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()


def _piece_bytes(piece: str) -> bytes:
    """The bytes of a sentencepiece token: <0xHH> is a byte, U+2581 a blank."""
    if m := re.fullmatch("<0x([0-9A-F]{2})>", piece):
        return bytes([int(m[1], 16)])
    return piece.replace("▁", " ").encode()


class Aligner:
    """Both tokenizers and the aligned pieces that this worker remembers."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        back = {c: b for b, c in _LETTERS.items()}
        self.bytes_a = [_letters_to_bytes(self.a.id_to_token(k) or "", back) for k in range(self.a.get_vocab_size())]
        names = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_b = [_piece_bytes(n) for n in names]
        self.length_a = np.array([len(b) for b in self.bytes_a])
        self.length_b = np.array([len(b) for b in self.bytes_b])
        self.blank = self.b.piece_to_id("▁")
        spec = json.loads(self.a.to_str())
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.byte_level = plain.items() <= (spec["pre_tokenizer"] or {}).items() and spec["normalizer"] is None and spec["model"]["type"] == "BPE"
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        #: Whether texts may be cut: no B token has a blank after another character, or a line end.
        self.cuts = self.byte_level and not any(re.search("[^▁]▁|\n", n) for n in names)
        self.clear()

    def clear(self) -> None:
        self.memo: dict[str, int] = {}
        self.ok: list[bool] = []
        self.text: list[str] = []  # groups as decimals
        self.numbers: list[tuple[int, int, int]] = []  # A tokens, B tokens, groups
        self.pairs: list[bytes] = []  # id pairs as 64-bit numbers (A id, then B id in the low half)
        self.links: list[bytes] = []  # their links, as 64-bit numbers

    def pieces(self, text: str) -> list[str]:
        """A blank and the text, in pieces that both vocabularies encode by themselves."""
        return PIECE.findall(" " + text) if self.cuts else [" " + text]

    def encode_a(self, some: list[str]) -> list[list[int]]:
        if not self.byte_level:
            return [e.ids for e in self.a.encode_batch_fast(some, add_special_tokens=False)]
        split = list(map(self.pattern.findall, some))
        tokenize, known = self.a.model.tokenize, {}
        for w in set().union(*split):
            printed = w.isascii() and w.isprintable()
            letters = w.replace(" ", _BLANK) if printed else w.encode().decode("latin-1").translate(_LETTERS)
            known[w] = [t.id for t in tokenize(letters)]
        return [known[words[0]] if len(words) == 1 else [i for w in words for i in known[w]] for words in split]

    def encode_b(self, some: list[str]) -> list[list[int]]:
        """B puts the blank before a text itself, unless the text is empty; a line end has none."""
        found = self.b.encode([s[1:] if s[0] == " " else s for s in some], num_threads=1)
        return [ids[1:] if s[0] != " " else ids if len(s) > 1 else [self.blank] for s, ids in zip(some, found, strict=True)]

    def tokens(self, some: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """The A and B ids of each piece; None if the bytes of either are not the piece's."""
        out: list = []
        for s, a, b in zip(some, self.encode_a(some), self.encode_b(some), strict=True):
            raw = s.encode()
            fits = b"".join(map(self.bytes_a.__getitem__, a)) == raw and b"".join(map(self.bytes_b.__getitem__, b)) == raw
            out.append((a, b) if fits else None)
        return out

    def learn(self, new: list[str]) -> None:
        """Align pieces and remember them."""
        for lo in range(0, len(new), STEP_PIECES):
            self._learn(new[lo: lo + STEP_PIECES])

    def _learn(self, new: list[str]) -> None:
        found = self.tokens(new)
        some = [f for f in found if f]
        if some:
            n_a, n_b = np.array([len(a) for a, _ in some]), np.array([len(b) for _, b in some])
            a = np.array([i for ids, _ in some for i in ids], dtype=np.int64)
            b = np.array([i for _, ids in some for i in ids], dtype=np.int64)
            shared = overlaps(self.length_a[a], self.length_b[b])
            of_a, of_b = groups(shared, len(b))
            piece = np.repeat(np.arange(len(some)), n_a)
            ends = np.cumsum(n_a) - 1
            n_groups = np.diff(of_a[ends], prepend=-1)
            # Rows (piece, A id) by groups, and groups by B ids.
            row_key, row = np.unique(piece << 20 | a, return_inverse=True)
            count = int(of_a[-1]) + 1
            m_a = from_entries(row, of_a, np.ones(len(a), dtype=np.int64), len(row_key), count)
            m_b = from_entries(of_b, b, np.ones(len(b), dtype=np.int64), count, len(self.bytes_b))
            linked = product(m_a, m_b)
            owner = row_key[linked.rows] >> 20
            pair = (row_key[linked.rows] & 0xFFFFF) << 32 | linked.indices
            cuts = (8 * np.searchsorted(owner, np.arange(len(some) + 1))).tolist()
            pairs, links = pair.astype("<i8").tobytes(), linked.data.astype("<i8").tobytes()
            first_a = [0, *np.cumsum(np.bincount(of_a)).tolist()]
            first_b = [0, *np.cumsum(np.bincount(of_b)).tolist()]
            text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
            each = [",".join(text_a[p:q]) + "|" + ",".join(text_b[r:s]) for p, q, r, s in zip(first_a, first_a[1:], first_b, first_b[1:], strict=False)]
            first_group = [0, *np.cumsum(n_groups).tolist()]
        k = -1
        for s, f in zip(new, found, strict=True):
            self.memo[s] = len(self.ok)
            self.ok.append(f is not None)
            if f is None:
                self.text.append("")
                self.numbers.append((0, 0, 0))
                self.pairs.append(b"")
                self.links.append(b"")
                continue
            k += 1
            self.text.append(";".join(each[first_group[k]: first_group[k + 1]]))
            self.numbers.append((len(f[0]), len(f[1]), int(n_groups[k])))
            self.pairs.append(pairs[cuts[k]: cuts[k + 1]])
            self.links.append(links[cuts[k]: cuts[k + 1]])

    @without_gc
    def places(self, texts: list[str | None]) -> list[list[int]]:
        """The remembered number of each piece of each text, after learning the new ones."""
        split = [self.pieces(t) if t else [] for t in texts]
        memo = self.memo
        self.learn(list(set().union(*split).difference(memo)))
        return [list(map(memo.__getitem__, p)) for p in split]


def aligner(path_a: str, path_b: str) -> Aligner:
    """This worker's aligner for two vocabulary files."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id_col, the ids a and b, the overlap links (places of the tokens and their
    shared bytes), and the groups (numbers of A and of B tokens, in order).

    Null and empty texts, and texts whose bytes the tokens of A or of B do not give back, have no
    tokens. Repeated rows come back as often, an empty table gives no rows, other columns play no
    part. One text, its tokens and links must fit a task's memory.
    """
    base = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    links = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("bytes", pa.int32())]))
    sizes = pa.list_(pa.struct([("n_a", pa.int32()), ("n_b", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for batch in batches:
            for part in slices(batch, "text", 64):
                out = []
                for text in part.column("text").to_pylist():
                    found = own.tokens(own.pieces(text)) if text else [None]
                    if None in found:
                        out.append(([], [], [], []))
                        continue
                    a, b = ([i for f in found for i in f[k]] for k in (0, 1))
                    shared = overlaps(own.length_a[a], own.length_b[b])
                    of_a, of_b = groups(shared, len(b))
                    out.append((a, b, [{"a": i, "b": j, "bytes": n} for i, j, n in zip(shared.rows.tolist(), shared.indices.tolist(), shared.data.tolist(), strict=True)],
                                [{"n_a": i, "n_b": j} for i, j in zip(np.bincount(of_a).tolist(), np.bincount(of_b).tolist(), strict=True)]))
                kinds = (pa.list_(pa.int32()), pa.list_(pa.int32()), links, sizes)
                yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True))],
                                                 names=["id", "a", "b", "links", "groups"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(base, work, f"id {kind}, a array<int>, b array<int>, links array<struct<a int, b int, bytes int>>, "
                                 "groups array<struct<n_a int, n_b int>>").withColumnRenamed("id", id_col)


_CHUNK = "chunk long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, held binary, place int, pair long, n long"


def _chunks(base: DataFrame, path_a: str, path_b: str, kind: str) -> DataFrame:
    """(id, text) -> stored rows of chunks: one for each document (with its pairs as places in the
    chunk's list of pairs, and their links) and one for each different pair of the chunk."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, packer = aligner(path_a, path_b), zstandard.ZstdCompressor(level=1)
        number, size = TaskContext.get().partitionId() << 33, 0  # type: ignore[union-attr]
        known: dict[int, int] = {}  # pair -> its place in the chunk's list
        seen = np.zeros(1024, dtype=np.int64)  # documents with the pair

        def pairs() -> Iterator[pa.RecordBatch]:
            order = np.fromiter(known, dtype=np.int64, count=len(known))
            for lo in range(0, len(order), 100_000):
                some = order[lo: lo + 100_000]
                place = np.arange(lo, lo + len(some))
                yield batch_of({"chunk": pa.array(np.full(len(some), number)), "place": pa.array(place.astype(np.int32)),
                                "pair": pa.array(some), "n": pa.array(seen[place])}, len(some))

        def batch_of(columns: dict[str, pa.Array], rows: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns.get(f.name, None) if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema=schema)

        schema = None
        for batch in batches:
            if schema is None:
                schema = pa.schema([("chunk", pa.int64()), ("id", batch.schema.field("id").type), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                                    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("held", pa.binary()), ("place", pa.int32()), ("pair", pa.int64()), ("n", pa.int64())])
            for part in slices(batch, "text"):
                if len(own.memo) > MEMO_ROWS:
                    own.clear()
                texts = part.column("text").to_pylist()
                split = own.places(texts)
                split = [p if all(map(own.ok.__getitem__, p)) else [] for p in split]
                used = np.unique(np.fromiter((k for p in split for k in p), dtype=np.int64))
                # Pieces by pairs, the pairs as places in the chunk's list.
                keys = np.frombuffer(b"".join([own.pairs[k] for k in used.tolist()]), dtype="<i8")
                links = np.frombuffer(b"".join([own.links[k] for k in used.tolist()]), dtype="<i8")
                widths = np.array([len(own.pairs[k]) // 8 for k in used.tolist()], dtype=np.int64)
                different, at = np.unique(keys, return_inverse=True)
                place = np.array([known.setdefault(k, len(known)) for k in different.tolist()], dtype=np.int64)
                if len(known) > len(seen):
                    seen = np.append(seen, np.zeros(2 * len(known) - len(seen), dtype=np.int64))
                by_piece = CSR(np.append(0, np.cumsum(widths)), place[at] if len(at) else at, links, len(known))
                numbers = np.array([own.numbers[k] for k in used.tolist()], dtype=np.int64).reshape(-1, 3)
                out, begin = [], 0
                while begin < len(split):  # texts by pieces, some places at a time
                    end, places = begin, 0
                    while end < len(split) and (end == begin or places + len(split[end]) <= STEP_PLACES):
                        places += len(split[end])
                        end += 1
                    widths = np.array([len(p) for p in split[begin:end]])
                    pieces = np.searchsorted(used, np.fromiter((k for p in split[begin:end] for k in p), dtype=np.int64, count=places))
                    row = np.repeat(np.arange(end - begin), widths)
                    by_text = product(from_entries(row, pieces, np.ones(places, dtype=np.int64), end - begin, max(1, len(used))), by_piece)
                    seen += np.bincount(by_text.indices, minlength=len(seen))
                    sums = np.zeros((end - begin, 3), dtype=np.int64)
                    np.add.at(sums, row, numbers[pieces])
                    for k in range(end - begin):
                        a, b = by_text.indptr[k], by_text.indptr[k + 1]
                        at, n = by_text.indices[a:b], by_text.data[a:b]
                        raw = np.concatenate([np.diff(at, prepend=0), n]).astype("<i4").tobytes()
                        p = split[begin + k]
                        digest = hashlib.sha256(";".join(map(own.text.__getitem__, p)).encode()).hexdigest() if p else ""
                        out.append((*sums[k].tolist(), int(n.sum()), digest, packer.compress(raw)))
                    begin = end
                columns = dict(zip(("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "held"), zip(*out, strict=True), strict=True))
                yield batch_of({"chunk": pa.array(np.full(len(out), number)), "id": part.column("id"),
                                **{c: pa.array(v, schema.field(c).type) for c, v in columns.items()}}, len(out))
                size += sum(len(t) for t in texts if t)
                if size >= CHUNK_BYTES:
                    yield from pairs()
                    known, size, number = {}, 0, number + 1
                    seen[:] = 0
        if known:
            yield from pairs()

    return materialise(map_arrow(base, work, _CHUNK.format(kind=kind)), "alignment-chunks")


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, count, best): documents that hold the pair linked, and whether no pair of its A id has more."""
    counts = materialise(chunks.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("count")), "alignment-pairs")
    a = F.shiftright("pair", 32)
    top = counts.groupBy(a.alias("a")).agg(F.max("count").alias("most"))  # a row for each id of A's vocabulary at most
    return counts.withColumn("a", a).join(F.broadcast(top), "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def alignment_report(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    Null and empty texts, and texts whose bytes the tokens of A or of B do not give back, have
    zeros and an empty groups_sha256. A repeated row counts as a document each time and comes back
    as often; rows of one id are documents of their own; an empty table gives no rows; other
    columns play no part. One text and its tokens must fit a task's memory.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    chunks = _chunks(docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")), path_a, path_b, kind)
    marked = chunks.where("pair IS NOT NULL").select("chunk", "place", "pair").join(pair_counts(chunks), "pair").select("chunk", "place", "count", "best")
    texts = chunks.where("pair IS NULL").drop("place", "pair", "n")
    both = marked.unionByName(texts, allowMissingColumns=True).withColumn("last", F.col("place").isNull())
    dealt = both.repartition("chunk").sortWithinPartitions("chunk", "last", "place")  # a chunk is of bounded text
    fields = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, now, held, best, lists = zstandard.ZstdDecompressor(), None, [], None, None
        for batch in batches:
            chunk, last = batch.column("chunk").to_numpy(), batch.column("last").to_numpy(zero_copy_only=False)
            cuts = (np.flatnonzero((chunk[1:] != chunk[:-1]) | (last[1:] != last[:-1])) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(chunk)], strict=True):
                part = batch.slice(a, b - a)
                if chunk[a] != now:
                    now, held, lists = chunk[a], [], None
                if not last[a]:
                    held.append((part.column("count").to_numpy(), part.column("best").to_numpy(zero_copy_only=False)))
                    continue
                if lists is None:  # the counts of all pairs of the chunk, by place
                    lists = tuple(map(np.concatenate, zip(*held, strict=True))) if held else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool))
                    held = []
                count, best = lists
                sums = []
                for raw in part.column("held").to_pylist():
                    both = np.frombuffer(reader.decompress(raw), dtype="<i4") if raw else np.zeros(0, dtype=np.int32)
                    at, n = np.cumsum(both[: len(both) // 2]), both[len(both) // 2:].astype(np.int64)
                    sums.append((int(n[best[at]].sum()), int((n * count[at]).sum())))
                n_best, count_sum = (pa.array(c, pa.int64()) for c in zip(*sums, strict=True))
                columns = {**{c: part.column(c) for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")}, "n_best": n_best, "count_sum": count_sum}
                yield pa.RecordBatch.from_arrays([part.column("id"), *(columns[f] for f in fields)], names=["id", *fields])

    schema = f"id {kind}, " + ", ".join(f"{f} {'string' if f == 'groups_sha256' else 'long'}" for f in fields)
    return map_arrow(dealt, work, schema).withColumnRenamed("id", id_col)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY_A), public_tokenizers.path(VOCABULARY_B))
