"""Periodic runs against a plain search over all periods."""

from __future__ import annotations

import hashlib
import random
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest

from larder.llm import periodic_runs
from tests.llm import helpers


def plain_runs(words: list, least: int = 24) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by trying every period at every place."""
    n, seen = len(words), {}
    for q in range(1, n // 3 + 1):
        k = 0
        while k < n - q:
            e = k
            while e < n - q and words[e] == words[e + q]:
                e += 1
            if e + q - k >= max(least, 3 * q):
                seen.setdefault((k, e + q), q)
            k = max(e, k) + 1
    return sorted((s, e - s, q) for (s, e), q in seen.items())


def plain_report(doc_id, text, planted: bool) -> tuple:
    words = helpers.WORD.findall(text or "")
    h = crc32(str(doc_id).encode())
    if planted and doc_id is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def texts(seed: int) -> list[str | None]:
    rng = random.Random(seed)
    out = helpers.awkward_texts(seed)
    for _ in range(40):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            period = helpers.prose(rng, rng.randrange(1, 40), rng.choice([2, 3, 50])).split()
            parts += helpers.prose(rng, rng.randrange(0, 30)).split() + (period * rng.randrange(2, 12))[: rng.randrange(1, 200)]
        out.append(" ".join(parts))
    return out


def rows(df) -> dict:
    fields = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return {r["doc_id"]: tuple(r[f] for f in fields) for r in df.collect()}


@pytest.mark.parametrize("step", [16, 4096])
def test_report_equals_plain_search(spark, monkeypatch, step):
    monkeypatch.setattr(periodic_runs, "TILE_STEP", step)  # 16: many tiles to stitch
    some = texts(3)
    docs = helpers.documents(spark, some)
    assert rows(periodic_runs.run_report(docs)) == {k: plain_report(k, t, False) for k, t in enumerate(some)}
    assert rows(periodic_runs.run_report(periodic_runs.plant(docs))) == {k: plain_report(k, t, True) for k, t in enumerate(some)}


@pytest.mark.parametrize("step", [8, 64])
def test_tiles_find_every_run(monkeypatch, step):
    """Small alphabets: nested, overlapping and touching runs of many periods."""
    monkeypatch.setattr(periodic_runs, "TILE_STEP", step)
    rng = random.Random(step)
    for _ in range(120):
        alphabet, n = rng.choice([1, 2, 3]), rng.randrange(0, 200)
        words = [rng.randrange(alphabet) for _ in range(n)]
        if n > 60 and rng.random() < 0.7:
            a, p = rng.randrange(n // 2), rng.randrange(1, 25)
            words[a:] = [words[a + i % p] for i in range(n - a)]
        ids, found = np.array(words, dtype=np.int32), {}
        for p, low, begin, end in periodic_runs.tiles(ids):
            for q, lo, hi in zip(*periodic_runs.solve(ids[begin:end], p, low), strict=True):
                found.setdefault(int(q), []).append((int(lo) + begin, int(hi) + begin))
        whole = {}
        for q, spans in found.items():
            merged = []
            for lo, hi in sorted(spans):
                if merged and merged[-1][1] - lo >= q:
                    merged[-1][1] = max(hi, merged[-1][1])
                else:
                    merged.append([lo, hi])
            for lo, hi in merged:
                whole[lo, hi] = min(q, whole.get((lo, hi), q))
        assert sorted((lo, hi - lo, q) for (lo, hi), q in whole.items()) == plain_runs(words)


def test_rows_of_one_id_collapse_and_extra_columns(spark):
    period = " ".join(f"p{k}" for k in range(10))
    other = " ".join(["ab"] * 30)
    docs = spark.createDataFrame([(5, " ".join([period] * 4), "x"), (5, other, "y"), (5, other, "y"), (None, other, None), (6, None, "z"), (7, "", "z"), (8, " a  b ", "z")],
                                 "doc_id long, text string, row string")
    found = sorted((r["doc_id"] is None, r["start"], r["length"], r["period"]) for r in periodic_runs.find_runs(docs).collect())
    assert found == [(False, 0, 30, 1), (False, 0, 30, 1), (False, 0, 40, 10), (True, 0, 30, 1)]
    left = periodic_runs.collapse_runs(docs)
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect()), key=str) == sorted(
        [(5, period, "x"), (5, "ab", "y"), (5, "ab", "y"), (None, "ab", None), (6, None, "z"), (7, "", "z"), (8, " a  b ", "z")], key=str)
    planted = periodic_runs.run_report(periodic_runs.plant(docs)).collect()
    assert len(planted) == 7


def test_empty_table_and_one_long_text(spark):
    docs = helpers.documents(spark, [])
    assert periodic_runs.run_report(docs).collect() == [] and periodic_runs.find_runs(docs).collect() == []
    rng = random.Random(4)
    period = helpers.prose(rng, 7000, 5000).split()
    words = helpers.prose(rng, 500).split() + period * 4 + ["end"] * 3
    found = [tuple(r)[1:] for r in periodic_runs.find_runs(helpers.documents(spark, [" ".join(words)])).collect()]
    assert len(found) == 1 and found[0][2] == 7000 and found[0][1] >= 28_000
