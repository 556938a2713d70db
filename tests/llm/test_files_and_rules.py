"""WARC archives, sharding and host quality rules."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import zlib
from collections import Counter

import duckdb
import pytest
import xxhash

from larder.llm import hostrules, license_scan, sharding, warc
from larder.llm.hostrules import OP9_SQL
from tests.conftest import SF_SMOKE
from tests.llm import helpers

PAGES = [(0, "http://a.example/x y", "<p>one</p>"), (1, None, None), (2, "https://b.example", ""), (3, "http://a.example/\r\nWARC/1.1", "same"),
         (9, "http://c.example/9", "same"), (4, "", "same"), (5, "u", "a\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n"), (6, "http://d.example/é", "é\n" * 5000),
         (7, "x", "line\r\n"), (8, "x", "\r\n\r\n")]


def expected(pages):
    largest = {}
    for i, _, h in pages:
        largest[h or ""] = max(i, largest.get(h or "", i))
    out = {}
    for i, _, h in pages:
        payload = (h or "").encode()
        owner = largest[h or ""]
        out[i] = (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "response" if i == owner else "revisit", None if i == owner else owner)
    return out


def pages_df(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, copy int")


def test_archives_round_trip_and_assemble(spark, tmp_path):
    out = str(tmp_path / "warc")
    warc.write_archives(pages_df(spark, PAGES), out)
    records = warc.read_records(spark, out).cache()
    assert Counter(r["type"] for r in records.collect()) == {"request": 10, "metadata": 10, "response": 7, "revisit": 3}
    captures = warc.assemble(records)
    rows = captures.collect()
    assert len(rows) == len(PAGES) and all(r["request"] and r["response"] and r["metadata"] for r in rows)
    bodies = {int(r["metadata"]["fields"]["page-id"]): r["response"]["payload"] for r in rows if r["response"]["type"] == "response"}
    assert {i: bytes(b).decode() for i, b in bodies.items()} == {i: h or "" for i, _, h in PAGES if expected(PAGES)[i][2] == "response"}
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.capture_report(captures).collect()}
    assert got == expected(PAGES)
    assert len({r["capture"] for r in rows}) == len(PAGES)


def test_repeated_and_null_page_ids(spark, tmp_path):
    out = str(tmp_path / "warc")
    warc.write_archives(pages_df(spark, [(5, "u", "z")] * 3 + [(None, "u", "z"), (None, "v", "only")]), out)
    rows = warc.capture_report(warc.assemble(warc.read_records(spark, out, payloads=False))).collect()
    assert Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in rows) == {
        (5, "response", None, 1): 1, (5, "revisit", 5, 1): 2, (None, "revisit", 5, 1): 1, (None, "response", None, 4): 1}


def test_no_pages(spark, tmp_path):
    out = str(tmp_path / "warc")
    warc.write_archives(pages_df(spark, []), out)
    assert warc.assemble(warc.read_records(spark, out)).collect() == []


def test_records_without_partners_still_give_rows(spark, tmp_path):
    out = tmp_path / "warc"
    out.mkdir()
    one = b"WARC/1.1\r\nWARC-Type: request\r\nWARC-Record-ID: <r>\r\nWARC-Concurrent-To: <gone>\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    (out / "a.warc.gz").write_bytes(gzip.compress(one))
    rows = warc.assemble(warc.read_records(spark, str(out))).collect()
    assert len(rows) == 1 and rows[0]["response"] is None and rows[0]["request"]["record_id"] == "r"
    (out / "a.warc.gz").write_bytes(gzip.compress(one.replace(b"Length: 0", b"Length: 50")))
    with pytest.raises(Exception, match="cut short"):
        warc.read_records(spark, str(out)).collect()


@pytest.mark.parametrize("bucket_bytes", [2000, 1 << 20])
def test_shards_hold_every_row_once(spark, tmp_path, bucket_bytes):
    texts = helpers.awkward_texts()
    docs = helpers.documents(spark, texts)
    written = sharding.write_shards(docs, str(tmp_path / "s"), bucket_bytes=bucket_bytes)
    assert written.columns == [*docs.columns, "bucket", "place", "shard_"] and written.drop("bucket", "place", "shard_").schema == docs.schema
    rows = sharding.slots(written, "shard_").collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    assert all(r["text"] == texts[r["doc_id"]] for r in rows)
    by: dict = {}
    for r in rows:
        by.setdefault(r["shard_"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_one_more_shard_takes_rows_only_into_itself(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "k")
    rows = keys.select(*[sharding.key_shard(keys.k, n).alias(f"s{n}") for n in (8, 9)]).collect()
    assert all(r["s9"] in (r["s8"], 8) for r in rows)
    sizes = Counter(r["s9"] for r in rows)
    assert len(sizes) == 9 and max(sizes.values()) < 1.15 * min(sizes.values())


def test_sharding_is_repeatable_shuffled_and_spreads_a_hot_id(spark, tmp_path, monkeypatch):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('x', 50) AS text")
    first, again = ([(r["shard"], r["bucket"], r["place"], r["doc_id"]) for r in sharding.write_shards(docs, str(tmp_path / f"s{k}"), bucket_bytes=4000)
                     .orderBy("shard", "bucket", "place").collect()] for k in (1, 2))
    assert first == again
    inside = [i for s, b, _, i in first if (s, b) == first[0][:2]]
    assert inside != sorted(inside)
    monkeypatch.setattr(sharding, "COPIES", 100)
    hot = docs.selectExpr("IF(doc_id % 3 = 0, 7, doc_id) AS doc_id", "text")
    dealt = [sharding.slots(sharding.write_shards(hot.repartition(n, "doc_id"), str(tmp_path / f"hot{n}"), bucket_bytes=4000))
             .select("doc_id", "text", "shard", "bucket", "slot").collect() for n in (1, 7)]
    of_hot = Counter(r["bucket"] for r in dealt[0] if r["doc_id"] == 7)
    assert sum(of_hot.values()) == 1001 and len(of_hot) > 2 and max(of_hot.values()) <= 500 and len(dealt[0]) == 3000
    assert sorted(dealt[0]) == sorted(dealt[1])  # whatever the partitions of the input


def xxh64(*values):
    """Spark's hash of a row of ints (32 bits), longs (pairs of value and 8) and strings."""
    h = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else v[0].to_bytes(v[1], "little", signed=True) if isinstance(v, tuple) else v.to_bytes(4, "little", signed=True)
        h = xxhash.xxh64_intdigest(raw, h)
    return h - (1 << 64) if h >> 63 else h


def test_shards_and_buckets_equal_a_plain_loop(spark, tmp_path):
    rows = [(k, f"text {k % 90} " * (k % 7)) for k in range(400)] + [(5, "again")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    written = sharding.write_shards(docs, str(tmp_path / "p"), shards=5, bucket_bytes=1000)
    buckets = math.ceil(sum(len(t.encode()) + 1 for _, t in rows) / 5 / 1000)
    want = Counter()
    for i, t in rows:
        weights = [xxh64(sharding.SEED, s, (i, 8)) for s in range(5)]
        want[i, t, weights.index(max(weights)), xxh64(sharding.SEED + 1, (xxh64((i, 8), t), 8), 0) % buckets] += 1
    assert buckets > 1 and Counter((r["doc_id"], r["text"], r["shard"], r["bucket"]) for r in written.collect()) == want


def test_sharding_of_nulls_and_nothing(spark, tmp_path):
    docs = spark.createDataFrame([(None, None), (None, "a"), (1, "a"), (1, "a")], "doc_id long, text string")
    written = sharding.write_shards(docs, str(tmp_path / "n"))
    assert Counter((r["doc_id"], r["text"]) for r in written.collect()) == {(None, None): 1, (None, "a"): 1, (1, "a"): 2}
    assert sharding.write_shards(helpers.documents(spark, []), str(tmp_path / "e")).collect() == []


def counts(text):
    words = helpers.WORD.findall(text or "")
    windows = Counter(tuple(words[k: k + 5]) for k in range(len(words) - 4))
    covered = {j for k in range(len(words) - 4) if windows[tuple(words[k: k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in (text or "").split("\n") if helpers.WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_rule_counts_match_brute_force(spark):
    texts = helpers.awkward_texts() + ["a\nb\na\n\n a\na", "# * $ % & | < > ###", "\n\n", "a b c d e a b c d e f a b c d e", "x y " * 40]
    rows = hostrules.judge(helpers.documents(spark, texts)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in rows} == {k: counts(t) for k, t in enumerate(texts)}
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_bad_hosts_fall_and_thin_evidence_does_not(spark):
    good, bad = "this is a fine text with many different words in it today", "| a # b $ c % d & e * f < g > h | i # j $ k"
    rows = [(k, good, f"host{k % 8}") for k in range(400)]
    rows += [(1000 + k, bad, "spam") for k in range(50)] + [(2000, good, "spam"), (3000, bad, "tiny"), (3001, good, None), (3002, bad, None)]
    out = {r["doc_id"]: r for r in hostrules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out[2000]["host_rejected"] and not out[2000]["kept"] and not out[2000]["base_failed"]
    assert not out[3000]["host_rejected"] and out[3001]["kept"] and out[3002]["kept"]
    assert all(out[k]["kept"] for k in range(400))


def test_rules_on_nothing(spark):
    assert hostrules.judge(helpers.documents(spark, [])).collect() == []


@pytest.mark.parametrize("name, sql", [("op1_license_scan", license_scan.OP1_SQL), ("op4_warc_transactions", warc.OP4_SQL), ("op9_host_quality_rules", OP9_SQL)])
def test_queries_match_their_sql(spark, name, sql):
    from larder.llm.queries import QUERIES

    duck = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    rel, df = duck.sql(sql), QUERIES[name](spark, SF_SMOKE)
    order = [df.columns.index(c) for c in rel.columns]
    assert sorted(rel.columns) == sorted(df.columns)
    assert sorted((tuple(r[i] for i in order) for r in df.collect()), key=repr) == sorted(rel.fetchall(), key=repr)


def test_sharding_query_on_the_test_table(spark):
    rows = sharding.op8_two_pass_sharding(spark, SF_SMOKE).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMOKE}/documents.parquet").collect()}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == {(i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts.items()}
