"""Nearest neighbours against a full search."""

from __future__ import annotations

import math

import numpy as np
import pytest

from larder.llm import nearest


def full(rows: list[tuple], queries: list[tuple], k: int = 10) -> dict[int, list]:
    """Each query's nearest rows by trying all; (id, vector) rows, distinct ids."""
    def fine(v):
        return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v) and any(v)

    out = {}
    for i, v in queries:
        if i is not None and fine(v):
            a = np.array(v, dtype=np.float64)
            near = sorted((float(np.sqrt(((np.array(w, dtype=np.float64) - a) ** 2).sum())), j) for j, w in rows
                          if j is not None and fine(w) and len(w) == len(v) and (j != i or list(w) != list(v)))
            out[i] = list(dict.fromkeys(near))[:k]
    return out


def found(df) -> dict[int, list]:
    out: dict[int, list] = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def same(got: dict, want: dict) -> None:
    assert {k: [j for _, j in v] for k, v in got.items()} == {k: [j for _, j in v] for k, v in want.items() if v}
    for k, v in got.items():
        assert [s for s, _ in v] == pytest.approx([s for s, _ in want[k]], abs=1e-12)


def normal(n: int, dim: int, seed: int = 1) -> list[list[float]]:
    return np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32).astype(float).tolist()


def test_recall_and_exact_scores(spark):
    rows = list(enumerate(normal(3000, 64)))
    unit = [(i, (np.array(v) / np.linalg.norm(v)).astype(np.float32).astype(float).tolist()) for i, v in rows]
    queries = [r for r in unit if r[0] % 100 == 0]
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame(unit, schema).repartition(4)
    got, want = found(nearest.search(df, df.where("vec_id % 100 = 0"))), full(unit, queries)
    assert {k: len(v) for k, v in got.items()} == dict.fromkeys(want, 10)
    hits = sum(len({j for _, j in got[k]} & {j for _, j in want[k]}) for k in want)
    assert hits >= 0.9 * 10 * len(want)
    vectors = dict(unit)
    for k, near in got.items():
        assert near == sorted(near)
        for s, j in near:
            assert s == pytest.approx(math.dist(vectors[k], vectors[j]), abs=1e-12)


@pytest.mark.parametrize("rows, block", [(7, 16_384), (300, 16)])
def test_all_buckets_are_a_full_search(spark, monkeypatch, rows, block):
    """With every bucket probed the result is the full search's, whatever the blocks."""
    monkeypatch.setattr(nearest, "BLOCK_ROWS", block)
    monkeypatch.setattr(nearest, "BLOCK_QUERIES", block)
    data = list(enumerate(normal(rows, 12, 5)))
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3)
    same(found(nearest.search(df, df, probes=0)), full(data, data))


def test_fewer_candidates_than_asked_for(spark):
    data = list(enumerate(normal(6, 64, 3)))
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    same(found(nearest.search(df, df.where("vec_id = 0"), probes=1)), full(data, data[:1]))


def test_copies_ties_nulls_and_odd_vectors(spark):
    one = [1.0, 0.0, 0.0, 0.0]
    data = [(k, one) for k in range(40)]  # copies: ties go to the smaller id
    data += [(100, [-1.0, 0.0, 0.0, 0.0]), (101, None), (102, []), (103, [0.0] * 4), (104, [1.0, None, 0.0, 0.0]), (105, [1.0, float("nan"), 0.0, 0.0]),
             (106, [1.0, float("inf"), 0.0, 0.0]), (None, one), (107, [1.0, 2.0]), (108, [2.0, 1.0]), (109, [1e200, 0.0, 0.0, 1e-200]), (110, [5e-324] * 4), (111, one), (111, one)]
    df = spark.createDataFrame([(i, v, "x", 0.5, 7) for i, v in data], "vec_id long, embedding array<double>, key string, score double, rank int").repartition(3)
    got = found(nearest.search(df, df))
    want = full(data, data)
    assert got.keys() == want.keys() - {k for k, v in want.items() if not v}
    for k in (0, 5, 39, 107, 108, 110, 111):
        assert [j for _, j in got[k]] == [j for _, j in want[k]], k
    assert [j for _, j in got[100]] == [110, *range(9)] and [j for _, j in got[107]] == [108]


def test_queries_of_one_id_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.1])], schema)
    rows = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in nearest.search(df, df.where("vec_id = 0")).collect())
    assert rows == [(0, 1, 1), (0, 1, 1), (0, 2, 0), (0, 2, 0)]
    empty = spark.createDataFrame([], schema)
    assert nearest.search(empty, empty).collect() == [] and nearest.search(empty, df).collect() == []


def test_rotations_keep_lengths_and_axes():
    x = np.array(normal(50, 24, 9))
    turned = nearest.rotate(x, 1)
    assert turned.shape == (50, 32)
    assert (turned ** 2).sum(axis=1) == pytest.approx(32 ** 3 * (x ** 2).sum(axis=1))
    assert (nearest.probe_axes(turned, 1)[:, 0] == nearest.axes(turned)).all()
    assert not np.allclose(turned, nearest.rotate(x, 0)) and np.allclose(turned, nearest.rotate(x, 1))
