"""Byte-level BPE and token-id files."""

from __future__ import annotations

import base64
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import tiktoken
from tokenizers import Tokenizer

from larder.llm import bpe, pieces, tokens_binary
from tests.llm import helpers

RANKS = public_tokenizers.path(bpe.VOCABULARY)
ODD = ["a" * 3000, "ab" * 1500, "hello  \n\n  world \t x", "  " * 200 + "x", "\x1c\x1d a\x85b\xa0 c d", "don't I'LL we've 'sx",
       "日本語テキスト" * 50, "", "   ", "\n \n", "a \n b", "１２３ ①② x²", "é ​x", "<|endoftext|> x", " lead", "trail ", "　 　x"]


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def le(ids) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def test_encoding_equals_the_library_and_decodes_back(spark, reference):
    texts = helpers.awkward_texts() + ODD
    rows = {r["doc_id"]: r for r in bpe.encode(helpers.documents(spark, texts), RANKS, decoded=True).collect()}
    assert len(rows) == len(texts)
    for k, t in enumerate(texts):
        assert bytes(rows[k]["ids"]) == le(reference.encode_ordinary(t or "")), repr((t or "")[:40])
        assert bytes(rows[k]["decoded"]) == (t or "").encode()


def test_decode_alone(spark, reference):
    texts = [t for t in ODD if t]
    df = spark.createDataFrame([(k, bytearray(le(reference.encode_ordinary(t)))) for k, t in enumerate(texts)] + [(99, None), (98, bytearray())], "doc_id long, ids binary")
    got = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(df, RANKS).collect()}
    assert got == {**{k: t.encode() for k, t in enumerate(texts)}, 99: b"", 98: b""}


def test_random_bytes_of_text_and_long_words(reference, monkeypatch):
    rng = random.Random(8)
    for limit in (1, 1024):  # all words by the heap, then all by the query
        monkeypatch.setattr(bpe, "LONG_WORD", limit)
        coder = bpe.Coder(RANKS, public_tokenizers.PATTERN)
        texts = ["".join(rng.choice("abcdeé 'ß\n1漢\U0001f600 .") for _ in range(rng.randrange(0, 80))) for _ in range(150)]
        assert coder.encode(texts) == [le(reference.encode_ordinary(t)) for t in texts]
    monkeypatch.setattr(bpe, "QUERY_TOKENS", 7)
    assert coder.decode(coder.encode(texts)) == [t.encode() for t in texts]
    with pytest.raises(ValueError):
        coder.decode([le([2**31])])


def test_pieces_in_use_and_words_stay_remembered(reference, monkeypatch):
    own = bpe.Coder(RANKS, public_tokenizers.PATTERN)
    own.memo.rows = 60
    asked: list[bytes] = []
    real = own.encode_words
    monkeypatch.setattr(own, "encode_words", lambda words: asked.extend(words) or real(words))
    for k in range(20):  # far more pieces seen once than are remembered, and one in every text
        texts = [f"x oftenseen x{k}a y{k}b z{k}c, {'q' * (k + 1)}w oftenseen, oftenseen. r{k}d s{k}e t{k}f u{k}g"]
        assert own.encode(texts) == [le(reference.encode_ordinary(t)) for t in texts]
    assert asked.count(b" oftenseen") == 1  # not again with a comma, nor when the memory was full
    assert len(own.memo.after) + len(own.memo.older[1]) < 60 + 20
    own.close()


def test_empty_tables(spark, tmp_path):
    docs = helpers.documents(spark, [])
    assert bpe.encode(docs, RANKS).count() == 0
    tokens_binary.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "none"))
    assert tokens_binary.read_digests(spark, str(tmp_path / "none")).collect() == []


def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_pieces_encode_like_whole_texts():
    whole, own = library(), tokens_binary.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(6)
    texts = ODD + ["".join(rng.choice("ab 1.'s \n\t é\xa0 \x1c") for _ in range(rng.randrange(0, 60))) for _ in range(500)]
    assert own.encode(texts) == [le(e.ids) for e in whole.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("block, file", [(400, 2000), (4 << 20, 64 << 20)])
def test_token_files_round_trip(spark, tmp_path, monkeypatch, block, file):
    monkeypatch.setattr(tokens_binary, "BLOCK_BYTES", block)
    monkeypatch.setattr(tokens_binary, "FILE_BYTES", file)
    texts = helpers.awkward_texts() + ODD
    out = str(tmp_path / "tokens")
    tokens_binary.write_tokens(helpers.documents(spark, texts), public_tokenizers.path("byte_bpe_50k.json"), out)
    rows = {r["id"]: r for r in tokens_binary.read_digests(spark, out).collect()}
    whole, start = library(), 0
    for k, t in enumerate(texts):
        ids = whole.encode(t or "", add_special_tokens=False).ids + [0]
        assert (rows[k]["start"], rows[k]["n_tokens"], rows[k]["ids_crc32"]) == (start, len(ids), zlib.crc32(le(ids)))
        start += len(ids)
    assert tokens_binary.lookup(spark, out, 7) == [whole.encode(texts[7], add_special_tokens=False).ids + [0]]
    assert tokens_binary.lookup(spark, out, 10_000) == []
    blocks = spark.read.parquet(out + "/blocks").orderBy("range", "first_start").collect()
    order = [i for b in blocks for i in b["ids"]]
    assert order == sorted(order) and len({b["dict_hash"] for b in blocks}) == 1


def test_token_files_with_null_and_repeated_ids(spark, tmp_path):
    docs = spark.createDataFrame([(None, "no id"), (3, "three"), (3, "three"), (3, "other"), (None, None)], "doc_id long, text string")
    out = str(tmp_path / "tokens")
    tokens_binary.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), out)
    rows = sorted((r["id"] is not None, r["start"], r["n_tokens"]) for r in tokens_binary.read_digests(spark, out).collect())
    assert [r[0] for r in rows] == [False, False, True, True, True]
    ends = [s + n for _, s, n in rows]
    assert [s for _, s, _ in rows] == [0, *ends[:-1]]
    assert len(tokens_binary.lookup(spark, out, 3)) == 3


def test_files_are_cut_by_bytes_and_a_hot_id_is_divided(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokens_binary, "FILE_BYTES", 8000)
    rng = random.Random(12)
    rows = [(k, helpers.prose(rng, 3 if k < 600 else 150)) for k in range(650)]  # the long texts have the largest ids
    rows += [(None, helpers.prose(rng, 30)) for _ in range(200)] + [(300, helpers.prose(rng, 30)) for _ in range(300)] + [(2**63 - 1, "last")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = str(tmp_path / "tokens")
    tokens_binary.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), out)
    got = sorted((r["start"], r["n_tokens"], r["id"], r["ids_crc32"]) for r in tokens_binary.read_digests(spark, out).collect())
    assert [s for s, *_ in got] == [0, *np.cumsum([n for _, n, *_ in got]).tolist()[:-1]]
    order = [i for *_, i, _ in got]
    assert order == [None] * 200 + sorted(i for i, _ in rows if i is not None)
    whole = library()
    want = sorted((i is not None, i or 0, zlib.crc32(le(whole.encode(t, add_special_tokens=False).ids + [0]))) for i, t in rows)
    assert sorted((i is not None, i or 0, c) for *_, i, c in got) == want
    text_bytes: dict = {}
    sizes = {c: len(t) for (_, t), c in zip(rows, (zlib.crc32(le(whole.encode(t, add_special_tokens=False).ids + [0])) for _, t in rows), strict=True)}
    crcs = {(i, s): c for s, _, i, c in got}
    assert len(crcs) == len(rows)
    _, starts, _ = tokens_binary.read_blocks(spark, out)
    begins = sorted(starts.values())
    for s, _, _, c in got:
        k = int(np.searchsorted(begins, s, side="right"))
        text_bytes[k] = text_bytes.get(k, 0) + sizes[c]
    assert len(text_bytes) > 10 and max(text_bytes.values()) < 2 * 4000


@pytest.mark.parametrize("seed", range(5))
def test_segments_keep_the_order_of_ids(seed):
    rng = random.Random(seed)
    lows = sorted(set(rng.choices(range(60), k=rng.randrange(0, 30))))
    size = {k: rng.choice([0, 5, 30, 500]) for k in range(len(lows) + 1)}
    r = tokens_binary.pack_segments(lows, size, rng.choice([0, 50, 900]), 100)
    ids = pa.array([None] * 30 + [i for i in range(-2, 62) for _ in range(30)], pa.int64())
    texts = pa.array([str(k) for k in range(len(ids))])
    found: dict = {}
    for i, x in zip(ids.to_pylist(), r.of(ids, texts), strict=True):
        found.setdefault(-9 if i is None else i, set()).add(x)
    spans = [(min(found[i]), max(found[i])) for i in sorted(found)]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False)) and 0 <= spans[0][0] and spans[-1][1] < r.count
    assert all(b[0] > a[1] for a, b in zip(spans, spans[1:], strict=False) if a[1] > a[0])  # nothing follows in a divided id's ranges
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False) if b[1] > b[0])  # nor precedes


def test_a_word_is_looked_up_once_for_texts_encoded_together():
    class Counting(dict):
        asked = 0

        def get(self, *a):
            Counting.asked += 1
            return super().get(*a)

    coder = tokens_binary.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["one two, trois\nété fünf." * 3] * 50 + ["a  b \x1c c", "", " lead", "trail "]
    coder.memo.after = Counting()
    assert coder.encode(texts) == [le(library().encode(t, add_special_tokens=False).ids) for t in texts]
    assert Counting.asked <= 12


def test_white_space_side_by_side_is_that_of_python():
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    found = pc.match_substring_regex(pa.array([c + "\n" for c in chars]), pieces._SIDE_BY_SIDE).to_pylist()
    assert [c for c, f in zip(chars, found, strict=True) if f] == [c for c in chars if re.match(r"\s", c)]
