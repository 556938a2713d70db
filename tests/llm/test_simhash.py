from __future__ import annotations

import random

import numpy as np
import pytest

from larder.llm import simhash
from larder.llm.components import components
from tests.llm import helpers


def test_fingerprints_and_components_match_brute_force(spark):
    texts = helpers.awkward_texts()
    rows = simhash.near_duplicates(helpers.documents(spark, texts)).collect()
    prints = {k: helpers.simhash(t) for k, t in enumerate(texts)}
    assert {r["doc_id"]: r["fingerprint"] % 2**64 for r in rows} == prints
    assert {r["doc_id"]: r["component"] for r in rows} == helpers.smallest_reachable(prints)


def test_one_row_of_each_group_stays_with_all_columns(spark):
    texts = helpers.awkward_texts()
    docs = helpers.documents(spark, texts)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    owners = helpers.smallest_reachable({k: helpers.simhash(t) for k, t in enumerate(texts)})
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(owners.values()))


def test_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (None, "lone row of words")],
                                 "doc_id long, text string")
    rows = {(r["doc_id"], r["component"]) for r in simhash.near_duplicates(docs).collect()}
    assert rows == {(None, 5), (5, 5), (None, None)}
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash.drop_near_duplicates(docs).collect()), key=str)
    assert kept == [(5, "a b c d e"), (None, "lone row of words")]


def test_empty_table(spark):
    docs = helpers.documents(spark, [])
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.drop_near_duplicates(docs).collect() == []


@pytest.mark.parametrize("distance", [0, 1, 4])
@pytest.mark.parametrize("n", [50, 10**6, 10**9, 10**12])
def test_every_plan_of_block_masks_is_exact(distance, n):
    masks = [m % 2**64 for m in simhash.block_masks(n, distance)]
    rng = random.Random(n + distance)
    for _ in range(300):
        flips = sum(1 << b for b in rng.sample(range(64), distance))
        assert any(not flips & m for m in masks)


@pytest.mark.parametrize("chunk", [8, 4096])
def test_crowded_groups_keep_every_link(spark, monkeypatch, chunk):
    """Fingerprints around few centres crowd the keys; links must equal brute force."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    monkeypatch.setattr(simhash, "SMALL", 6)
    rng = random.Random(3)
    values = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(60):
            values.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 9))))
    values |= {rng.getrandbits(64) for _ in range(60)}
    signed = {v - (1 << 64) if v >> 63 else v: v for v in values}
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r["fp"]: r["root"] for r in simhash.classes(prints).collect()}
    assert roots == helpers.smallest_reachable(dict(signed.items()))


def test_pivot_coordinates_bound_the_distance():
    refs = np.array(simhash.pivots(), dtype=np.int64).view(np.uint64)
    assert len(set(refs.tolist())) == simhash.PIVOTS
    a, b = (np.random.default_rng(k).integers(0, 2**63, 500, dtype=np.uint64) for k in (1, 2))
    gap = np.abs(np.bitwise_count(a[:, None] ^ refs).astype(int) - np.bitwise_count(b[:, None] ^ refs)).max(axis=1)
    assert (gap <= np.bitwise_count(a ^ b)).all()


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(8, 30)] + [(3, 3), (1, 2), (2, 1), (None, 4)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert found == {**{k: 100 for k in range(100, 161)}, **{k: 7 for k in range(7, 30)}, 1: 1, 2: 1}
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0
