"""Byte-level BPE encoding and decoding by DuckDB queries inside Spark tasks.

Texts are split by the vocabulary's pattern, each match is encoded by itself. In a task,
the different words of a slice of texts become rows (word, position, token), one for each
byte. A recursive query joins neighbouring tokens with the merge table, finds each word's
leftmost pair of the smallest rank, contracts it, and goes on with the words that had one,
until none has. Decoding joins token rows with the vocabulary and aggregates the bytes in
order of position.

The merge table has a row for every way to cut a vocabulary entry into two entries; its
size is the vocabulary's, not the data's.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, quoted, slices, table, without_gc
from .pieces import LETTERS, PieceMemo

#: Words that one recursive query contracts at a time, and rows that all its steps may have.
QUERY_WORDS, QUERY_ROWS = 10_000, 4_000_000
#: Texts whose new words are encoded together.
ENCODE_ROWS = 2048
#: Token rows that one query decodes at a time.
QUERY_TOKENS = 300_000
#: Words longer than this take one step of the query for nearly each byte; a heap merges them by the same rule.
LONG_WORD = 1024
DUCKDB_MEMORY = "256MB"
#: Encoded pieces that one Python worker remembers, beside the database.
MEMO_ROWS = 500_000

MERGE = """
WITH RECURSIVE t(step, word, pos, next, id) AS (
  SELECT 0, word, pos, next, id FROM start
  UNION ALL
  (WITH pair AS (
     SELECT a.step, a.word, a.pos, a.next, a.id, b.next AS after, m.merged
     FROM t a LEFT JOIN t b ON b.pos = a.next LEFT JOIN merges m ON m.pair = (a.id << 20 | b.id)),
   best AS (
     SELECT word, min(merged << 32 | pos) AS first, arg_min(next, merged << 32 | pos) AS gone
     FROM pair WHERE merged IS NOT NULL GROUP BY word)
   SELECT p.step + 1, p.word, p.pos,
          CASE WHEN p.pos = (b.first & 4294967295) THEN p.after ELSE p.next END,
          CASE WHEN p.pos = (b.first & 4294967295) THEN b.first >> 32 ELSE p.id END
   FROM pair p JOIN best b ON p.word = b.word WHERE p.pos <> b.gone))
SELECT t.word, list(t.id ORDER BY t.pos) AS ids
FROM t JOIN (SELECT word, max(step) AS last FROM t GROUP BY word) z ON z.word = t.word AND z.last = t.step
GROUP BY t.word ORDER BY t.word
"""
DECODE = "SELECT part, string_agg(bytes, '' ORDER BY pos) AS text FROM tokens JOIN vocabulary USING (id) GROUP BY part ORDER BY part"

_CODERS: dict[tuple[str, str], Coder] = {}


class Coder:
    """A vocabulary of ranks in DuckDB tables, for one Python worker."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.pattern = regex.compile(pattern)
        #: Whether the pattern is the vocabularies': a blank and letters are one match wherever they stand.
        self.plain = pattern == public_tokenizers.PATTERN
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = [(self.ranks[w[:k]] << 20 | self.ranks[w[k:]], r) for w, r in self.ranks.items() for k in range(1, len(w))
                 if w[:k] in self.ranks and w[k:] in self.ranks]
        self.merges = dict(pairs)
        columns = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        self.tables = {"merges": pa.table({"pair": columns[:, 0], "merged": columns[:, 1]}),
                       "vocabulary": pa.table({"id": np.array(list(self.ranks.values()), dtype=np.int32),
                                               "bytes": pa.array([w.decode("latin-1") for w in self.ranks])})}
        self.db: duckdb.DuckDBPyConnection | None = None
        self.memo = PieceMemo(self.encode_pieces, MEMO_ROWS)

    def close(self) -> None:
        """Give the database's memory back; the next query opens a new one."""
        if self.db is not None:
            self.db.close()
            self.db = None

    def _query(self, sql: str, name: str, rows: pa.Table) -> pa.Table:
        if self.db is None:
            self.db = duckdb.connect(config={"threads": 1, "memory_limit": DUCKDB_MEMORY, "temp_directory": "", "preserve_insertion_order": False})
            for table_name, content in self.tables.items():
                self.db.register("rows", content)
                self.db.execute(f"CREATE TABLE {table_name} AS SELECT * FROM rows")
                self.db.unregister("rows")
        self.db.register(name, rows)
        try:
            return self.db.sql(sql).to_arrow_table()
        finally:
            self.db.unregister(name)

    def _heap(self, word: bytes) -> list[int]:
        """One long word: the pair of the smallest rank, leftmost first, until none is left."""
        ids = self.byte_id[np.frombuffer(word, dtype=np.uint8)].tolist()
        n = len(ids)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        get = self.merges.get
        heap = [(r, k) for k in range(n - 1) if (r := get(ids[k] << 20 | ids[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            j = after[k]
            if ids[k] < 0 or j < 0 or get(ids[k] << 20 | ids[j]) != r:
                continue  # the pair is gone
            ids[k], ids[j], after[k] = r, -1, after[j]
            if after[k] >= 0:
                before[after[k]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b >= 0 and (s := get(ids[a] << 20 | ids[b])) is not None:
                    heapq.heappush(heap, (s, a))
        return [i for i in ids if i >= 0]

    @staticmethod
    def _batches(short: list[int], words: list[bytes]) -> Iterator[list[int]]:
        """Runs of words for one query: a word of n bytes has n rows at most in each of at most n steps."""
        lo = rows = 0
        for hi, k in enumerate(short):
            size = len(words[k]) ** 2
            if hi > lo and (rows + size > QUERY_ROWS or hi - lo == QUERY_WORDS):
                yield short[lo:hi]
                lo, rows = hi, 0
            rows += size
        if short:
            yield short[lo:]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of words, each encoded by itself, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        short = []
        for k, w in enumerate(words):
            rank = self.ranks.get(w)
            if rank is not None:  # a word of the vocabulary is one token
                out[k] = rank.to_bytes(4, "little")
            elif len(w) > LONG_WORD:
                out[k] = np.array(self._heap(w), dtype="<u4").tobytes()
            else:
                short.append(k)
        short.sort(key=lambda k: len(words[k]))  # words of one query take about as many steps
        for some in self._batches(short, words):
            sizes = np.array([len(words[k]) for k in some])
            ends = np.cumsum(sizes)
            pos = np.arange(ends[-1])
            following = pos + 1
            following[ends - 1] = -1
            ids = self.byte_id[np.frombuffer(b"".join(words[k] for k in some), dtype=np.uint8)]
            found = self._query(MERGE, "start", pa.table({"word": np.repeat(np.arange(len(some)), sizes).astype(np.int32),
                                                          "pos": pos.astype(np.int32), "next": following.astype(np.int32), "id": ids}))
            lists = found.column("ids").combine_chunks()
            flat = lists.flatten().to_numpy().astype("<u4").tobytes()
            cuts = (np.append(0, np.cumsum(lists.value_lengths().to_numpy())) * 4).tolist()
            for k, a, b in zip(some, cuts, cuts[1:], strict=False):
                out[k] = flat[a:b]
        return out

    @without_gc
    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces: of the words the pattern finds in them."""
        findall = self.pattern.findall
        split = [[p] if self.plain and LETTERS(p) else findall(p) for p in pieces]
        ids = {w: self.memo.word(w) if self.plain else None for s in split for w in s}
        new = [w for w, known in ids.items() if known is None]
        ids.update(zip(new, self.encode_words([w.encode() for w in new]), strict=True))
        if self.plain:
            self.memo.keep_words(ids)
        return [ids[s[0]] if len(s) == 1 else b"".join([ids[w] for w in s]) for s in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        return self.memo.encode(texts)

    def decode(self, rows: list[bytes]) -> list[bytes]:
        """The bytes of each row of ids; an id outside the vocabulary is an error."""
        out: list[list[bytes]] = [[] for _ in rows]
        held: list[tuple[int, np.ndarray]] = []
        size = 0

        def flush() -> None:
            counts = [len(i) for _, i in held]
            part = np.repeat(np.arange(len(held), dtype=np.int32), counts)
            pos = np.concatenate([np.arange(n, dtype=np.int32) for n in counts])
            ids = np.concatenate([i for _, i in held]).astype(np.int32)
            found = self._query(DECODE, "tokens", pa.table({"part": part, "pos": pos, "id": ids}))
            texts = dict(zip(found.column("part").to_pylist(), found.column("text").to_pylist(), strict=True))
            for k, (row, _) in enumerate(held):
                out[row].append(texts[k].encode("latin-1"))

        known = np.zeros(max(self.ranks.values()) + 1, dtype=bool)
        known[list(self.ranks.values())] = True
        for row, raw in enumerate(rows):
            ids = np.frombuffer(raw, dtype="<u4")
            if len(ids) and (int(ids.max()) >= len(known) or not known[ids].all()):
                raise ValueError("an id is not in the vocabulary")
            for k in range(0, len(ids), QUERY_TOKENS):
                some = ids[k: k + QUERY_TOKENS]
                if held and size + len(some) > QUERY_TOKENS:
                    flush()
                    held, size = [], 0
                held.append((row, some))
                size += len(some)
        if held:
            flush()
        return [b"".join(parts) for parts in out]


def coder(path: str, pattern: str) -> Coder:
    """This worker's coder for a vocabulary file."""
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = Coder(path, pattern)
    return _CODERS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """(id_col, ids binary) for each row of ``docs``; with ``decoded`` also the bytes of the ids.

    ``ids`` are little-endian unsigned 32-bit integers. Null and empty texts have none;
    special tokens' strings are ordinary text; repeated rows come back as often; an empty
    table gives no rows. One text and its ids must fit a task's memory.
    """
    base = docs.select(quoted(id_col).alias(id_col), quoted(text_col).alias("__text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            for part in slices(batch, "__text", ENCODE_ROWS):
                ids = own.encode([t or "" for t in part.column("__text").to_pylist()])
                columns = [part.column(id_col), pa.array(ids, pa.binary())]
                if decoded:
                    columns.append(pa.array(own.decode(ids), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "ids", "decoded"][: len(columns)])
        own.close()

    return map_arrow(base, work, f"`{id_col}` {dict(docs.dtypes)[id_col]}, ids binary" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, decoded binary): the bytes of each row's ids; null counts as no ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            for part in slices(batch, "__ids"):
                texts = own.decode([b or b"" for b in part.column("__ids").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(texts, pa.binary())], names=[id_col, "decoded"])
        own.close()

    return map_arrow(encoded.select(quoted(id_col).alias(id_col), quoted(ids_col).alias("__ids")), work, f"`{id_col}` {dict(encoded.dtypes)[id_col]}, decoded binary")


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def round_trip_digests(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded bytes, for ``documents``."""
    return encode(docs, path, pattern, decoded=True).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
