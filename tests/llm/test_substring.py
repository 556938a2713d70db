from __future__ import annotations

import random

import pytest

from larder.llm import substring
from tests.llm import helpers


def report(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()}


def test_awkward_texts_match_brute_force(spark):
    texts = helpers.awkward_texts()
    assert report(substring.removal_report(helpers.documents(spark, texts))) == helpers.removal(dict(enumerate(texts)))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_windows_of_a_small_vocabulary(spark, monkeypatch, seed):
    """Few different words: anchors are shared by texts that differ around them, so many
    windows are found only in the second round, and rows of a common anchor are dealt out."""
    monkeypatch.setattr(substring, "HOT_ROWS", 7)
    rng = random.Random(seed)
    bank = [helpers.prose(rng, 25, 3) for _ in range(6)]
    texts = [" ".join(rng.choice(bank) if rng.random() < 0.5 else helpers.prose(rng, 9, 3) for _ in range(4)) for _ in range(60)]
    assert report(substring.removal_report(helpers.documents(spark, texts), min_words=13)) == helpers.removal(dict(enumerate(texts)))


def test_rows_keep_columns_and_clean_texts(spark):
    texts = helpers.awkward_texts()
    docs = helpers.documents(spark, texts)
    left = substring.drop_repeats(docs)
    assert left.columns == docs.columns
    want = helpers.removal(dict(enumerate(texts)))
    for r in left.collect():
        n, gone, _ = want[r["doc_id"]]
        if gone:
            assert len(helpers.WORD.findall(r["text"])) == n - gone
        else:
            assert r["text"] == texts[r["doc_id"]]


def test_rows_of_one_id_and_without_id(spark):
    passage = " ".join(f"p{k}" for k in range(20))
    docs = spark.createDataFrame([(4, passage), (4, passage), (None, passage + " tail"), (None, passage + " tail")], "doc_id long, text string")
    rows = sorted(((r["doc_id"], r["n_removed"]) for r in substring.removal_report(docs).collect()), key=str)
    assert rows == [(4, 0), (4, 0), (None, 20), (None, 20)]


def test_texts_of_one_id_are_kept_apart(spark):
    """A row's repeats are taken out of that row alone, also where another text has its id."""
    passage = " ".join(f"p{k}" for k in range(13))
    lead, other = "a b c d e", " ".join(f"o{k}" for k in range(30))
    rows = [(1, passage), (2, lead + " " + passage), (2, other), (2, other + " " + passage), (3, other), (None, other), (None, passage + " x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in substring.removal_report(docs).collect()))
    assert got == sorted([("1", 13, 0), ("2", 18, 13), ("2", 30, 0), ("2", 43, 13), ("3", 30, 30), ("None", 30, 30), ("None", 14, 13)])
    left = sorted((str(r["doc_id"]), r["text"]) for r in substring.drop_repeats(docs).collect())
    assert left == sorted([("1", passage), ("2", lead), ("2", other), ("2", other), ("3", ""), ("None", ""), ("None", "x")])


@pytest.mark.parametrize("seed", [4, 5])
def test_repeated_ids_match_brute_force(spark, seed):
    """Several texts to an id: windows of smaller ids count, those of the same id do not."""
    rng = random.Random(seed)
    bank = [helpers.prose(rng, 25, 3) for _ in range(5)]
    rows = [(rng.randrange(12), " ".join(rng.choice(bank) if rng.random() < 0.5 else helpers.prose(rng, 9, 3) for _ in range(3))) for _ in range(50)]
    first: dict = {}
    split = [(i, helpers.WORD.findall(t)) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - 12):
            first[tuple(w[k: k + 13])] = min(i, first.get(tuple(w[k: k + 13]), i))
    want = sorted((i, len(w), len({j for k in range(len(w) - 12) if first[tuple(w[k: k + 13])] < i for j in range(k, k + 13)})) for i, w in split)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in substring.removal_report(docs).collect()) == want


def test_empty_table(spark):
    docs = helpers.documents(spark, [])
    assert substring.removal_report(docs).collect() == []
    assert substring.drop_repeats(docs).collect() == []


def test_automaton_knows_the_first_row_of_every_run():
    rng = random.Random(5)
    rows = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(0, 40))] for _ in range(12)]
    automaton = substring.Automaton()
    for row, words in enumerate(rows):
        for window in (1, 3, 6):
            want = [k for k in range(len(words) - window + 1) if any(
                words[k: k + window] == w[j: j + window] for w in rows[:row] for j in range(len(w) - window + 1))]
            assert automaton.repeats(words, row, window) == want
        automaton.add(words, row)


@pytest.mark.parametrize("gram", [1, 4, 13])
def test_equal_windows_have_an_equal_anchor(gram):
    rng = random.Random(gram)
    window = [f"q{k}".encode() for k in range(13)]
    for _ in range(20):
        left, right = ([f"z{rng.randrange(9)}".encode() for _ in range(rng.randrange(0, 20))] for _ in range(2))
        a = substring.anchors([window], gram, 13)[2]
        owner, place, h = substring.anchors([[b"x"], left + window + right], gram, 13)
        inside = {x for x, p in zip(h.tolist(), place.tolist()) if len(left) <= p <= len(left) + 13 - gram}
        assert set(a.tolist()) <= inside and (owner == 1).all()
