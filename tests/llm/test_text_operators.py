"""License scan, quality classifier and decontamination."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import decontaminate, license_scan, quality
from tests.llm import helpers

LICENSED = [
    None, "", "Released Under the MIT License. under-the-mit-license", "x licensed under the Apache License, Version 2.0 y",
    "CC BY-NC 4.0", "cc by\nnc", "under the mit licenses", "This work is licensed under the GNU General Public License, version 3.",
    "this work licensed under gnu general public license version 3", "the the under license", "under the émit license",
    "w " * 5000 + "under the mit license", "UNDER THE MIT LICENSE under the mit license under the mit license",
]


def test_license_phrases_and_templates(spark):
    rows = {r["doc_id"]: r for r in license_scan.scan(helpers.documents(spark, LICENSED)).collect()}
    at = lambda k: tuple(rows[k][c] for c in ("n_base", "first_word", "last_word", "base_labels"))
    assert at(0) == at(1) == (0, None, None, "")
    assert at(2) == (2, 1, 5, "mit")
    assert at(3) == (1, 4, 4, "apache-2")
    assert at(4) == (1, 0, 0, "cc-by-nc") == at(5)
    assert at(6) == at(10) == (0, None, None, "")
    assert at(11) == (1, 5000, 5000, "mit")
    assert at(12) == (3, 0, 8, "mit")
    assert rows[7]["labels"] == "gpl-3" and rows[7]["score"] == 1.0
    assert rows[8]["labels"] == "gpl-3" and 0.8 <= rows[8]["score"] < 1
    assert rows[9]["labels"] == "" and rows[9]["score"] == 0.0
    assert rows[0]["n_words"] == 0 and rows[11]["n_words"] == 5004


def blocks_with_templates(text, sets, threshold):
    """{label: largest containment} and the number of blocks that hold a template, by comparing all."""
    found, best, hits = license_scan.words(text.encode()), {}, set()
    for t in sets:
        for a in range(0, len(found), t.span):
            if a and a + t.span >= len(found):
                continue  # all of it stands in the block before
            inside = set(found[a: a + 2 * t.span])
            share = len(inside & t.words) / len(t.words)
            if share >= threshold - 1e-9 and t.required <= inside:
                hits.add((t.span, a))
                best[t.label] = max(best.get(t.label, 0), share)
    return best, len(hits)


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 1.0])
def test_license_join_finds_every_block_that_meets_the_threshold(spark, threshold):
    rng = random.Random(int(threshold * 10))
    sets = license_scan.template_sets(license_scan.TEMPLATES, license_scan.NAMES)
    words = sorted({w.decode() for t in sets for w in t.words}) + ["extra", "other"]
    texts = ["\n".join(" ".join(rng.sample(words, rng.randrange(1, 30))) for _ in range(rng.randrange(40))) for _ in range(60)]
    for k, t in enumerate(sets):
        some = sorted(w.decode() for w in t.words)
        texts[k] += "\n" + "\n".join(some[: max(1, round(len(some) * (threshold + 0.02)))])
    rows = {r["doc_id"]: r for r in license_scan.scan(helpers.documents(spark, texts), phrases={}, threshold=threshold).collect()}
    some = 0
    for k, t in enumerate(texts):
        best, n = blocks_with_templates(t, sets, threshold)
        assert rows[k]["labels"] == ",".join(sorted(best)) and rows[k]["n_template_blocks"] == n
        assert rows[k]["score"] == pytest.approx(max(best.values(), default=0.0))
        some += bool(best)
    assert some > 10


def test_licenses_are_found_however_they_are_wrapped(spark):
    rng = random.Random(3)
    texts, want = [], []
    for label, whole in license_scan.TEXTS.items():
        seq = whole[0].split()
        for width, lead, gap in ((5, "# ", "\n"), (11, " * ", "\n \n"), (len(seq), "", "\n")):
            wrapped = gap.join(lead + " ".join(seq[k: k + width]) for k in range(0, len(seq), width))
            texts.append(helpers.prose(rng, rng.randrange(700)) + " " + wrapped + " " + helpers.prose(rng, rng.randrange(700)))
            want.append(label)
    grant = license_scan.NOTICES["mit"][1]
    texts.append(grant.replace("obtaining a copy", "obtaining a copy\n"))
    want.append("mit")
    rows = {r["doc_id"]: r for r in license_scan.scan(helpers.documents(spark, texts)).collect()}
    for k, label in enumerate(want):
        assert label in rows[k]["labels"].split(",") and rows[k]["score"] == 1.0


def test_words_far_apart_or_without_the_name_are_no_license(spark):
    rng = random.Random(8)
    seq = license_scan.TEXTS["mit"][0].split()
    texts = [" ".join(w + " " + helpers.prose(rng, 25) for w in seq), "Released under the BSD License",
             license_scan.TEXTS["gpl-3"][0].replace("version 3", "version 2"), " ".join(seq[:12])]
    assert [r["labels"] for r in license_scan.scan(helpers.documents(spark, texts)).orderBy("doc_id").collect()] == [""] * len(texts)


def test_license_scan_of_nothing(spark):
    assert license_scan.scan(helpers.documents(spark, [])).collect() == []


def labelled(spark, n=400, seed=4):
    rng = random.Random(seed)
    texts, labels = [], []
    for k in range(n):
        good = rng.random() < 0.7
        text = helpers.prose(rng, 60)
        texts.append(text if good else " ".join(w + "***" if rng.random() < 0.7 else w for w in text.split()))
        labels.append((k, int(good), 0))
    return helpers.documents(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict((a, b) for a, b, _ in labels)


def test_training_equals_a_plain_loop():
    """FTRL-proximal, a coordinate at a time, against the vectors of the operator."""
    rng = random.Random(5)
    model, z, n = quality.Ftrl(4), [0.0] * 17, [0.0] * 17
    for _ in range(60):
        ids, label = [rng.randrange(16) for _ in range(rng.randrange(0, 30))], rng.randrange(2)
        model.learn(np.array(ids, dtype=np.int64), label)
        x = {i: ids.count(i) * quality.SCALE / len(ids) for i in ids} | {16: 1.0}
        w = {i: 0.0 if abs(z[i]) <= quality.L1 else -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + n[i] ** 0.5) / quality.ALPHA + quality.L2) for i in x}
        p = 1 / (1 + math.exp(-sum(w[i] * x[i] for i in x)))
        for i in x:
            g = (p - label) * x[i]
            sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / quality.ALPHA
            z[i] += g - sigma * w[i]
            n[i] += g * g
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_classifier_learns_one_text_of_an_id_and_replaces_a_score(spark):
    docs, labels, _ = labelled(spark, 100)
    crowd = docs.where("doc_id = 3").select(docs.columns[0], F.lit("zzz " * 30).alias("text"), *docs.columns[2:])
    crowd = crowd.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.lit(200)))).select(*docs.columns)
    once, often = (quality.train(docs.where("doc_id <> 3").union(crowd.limit(n)), labels) for n in (1, 200))
    assert once == often
    assert quality.add_score(docs, once).columns.count("score") == 1


def test_classifier_holds_out_a_fold_and_learns(spark):
    docs, labels, truth = labelled(spark)
    model = quality.train(docs, labels)
    rows = quality.add_score(docs.select("doc_id", "text"), model, out="p").select("doc_id", "p", quality.is_held_out(F.col("doc_id")).alias("held")).collect()
    held = [r for r in rows if r["held"]]
    assert 0.15 * len(rows) < len(held) < 0.35 * len(rows)
    assert sum((r["p"] >= 0.7) == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    # Labels of the held-out fold have no influence.
    flipped = labels.withColumn("quality", F.when(quality.is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.train(docs, flipped) == model


def test_classifier_scores_awkward_rows_and_keeps_columns(spark):
    docs, labels, _ = labelled(spark, 200)
    model = quality.train(docs, labels)
    odd = helpers.documents(spark)
    scores = [r["s"] for r in quality.add_score(odd, model, out="s").collect()]
    assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    assert quality.drop_low_quality(odd, labels).columns == odd.columns
    assert quality.add_score(helpers.documents(spark, []), model, out="s").collect() == []


def test_classifier_without_usable_labels(spark):
    docs = helpers.documents(spark)
    for rows in ([], [(None, 1)], [(5, None)], [(5, 0), (5, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        assert not quality.train(docs, labels).trained
        assert quality.drop_low_quality(docs, labels).count() == docs.count()


def items(spark, n=40, seed=9):
    rng = random.Random(seed)
    texts = [helpers.prose(rng, rng.randrange(10, 60), 3000).capitalize() + ". " + helpers.prose(rng, 8, 3000) + "." for _ in range(n)]
    return texts, spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_items_in_texts_are_found_and_clean_texts_are_not(spark):
    texts, table = items(spark)
    rng = random.Random(2)
    docs, want = [], set()
    for k in range(80):
        parts = [helpers.prose(rng, rng.randrange(0, 300), 3000)]
        if k % 2:
            j = rng.randrange(len(texts))
            parts += [texts[j].upper().replace(" ", "\n") if k % 3 == 0 else texts[j], helpers.prose(rng, rng.randrange(0, 300), 3000)]
            want.add((k, j))
        docs.append(" ".join(parts))
    df = helpers.documents(spark, docs)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(df, table).collect()} == want
    clean = decontaminate.drop_leaks(df, table)
    assert clean.columns == df.columns
    assert {r["doc_id"] for r in clean.collect()} == set(range(80)) - {k for k, _ in want}


def test_question_without_its_answer_is_no_leak(spark):
    _, table = items(spark)
    text = table.first()["text"]
    question = text[: text.index(". ") + 1]
    assert decontaminate.find_leaks(helpers.documents(spark, [question + " other words follow here"]), table).count() == 0


def found(df, table):
    return sorted((r["doc_id"], r["item_id"], r["first_word"], round(r["score"], 9)) for r in decontaminate.find_leaks(df, table).collect())


def test_items_in_rounds_and_of_any_length_give_the_same_rows(spark, monkeypatch):
    texts, table = items(spark)
    rng = random.Random(11)
    long = [helpers.prose(rng, n, 3000) + ". " + helpers.prose(rng, 9, 3000) + "." for n in (64, 150, 400, 900)]
    docs = helpers.documents(spark, texts + helpers.awkward_texts() + [helpers.prose(rng, 500, 3000) + " " + t + " " + helpers.prose(rng, 70, 3000) for t in long + texts[:4]])
    short = found(docs, table)
    both = table.union(spark.createDataFrame([(100 + k, t) for k, t in enumerate(long)], "item_id long, text string"))
    whole = found(docs, both)
    assert {(d, i) for d, i, _, _ in whole} == {(d, i) for d, i, _, _ in short} | {(len(texts) + len(helpers.awkward_texts()) + k, 100 + k) for k in range(4)}
    assert {x[:3] for x in whole if x[1] < 100} == {x[:3] for x in short}  # long items do not widen the passages of others
    clean = sorted(r["doc_id"] for r in decontaminate.drop_leaks(docs, both).collect())
    monkeypatch.setattr(decontaminate.build_indexes, "__defaults__", ("text", 4000))
    assert found(docs, both) == whole
    assert sorted(r["doc_id"] for r in decontaminate.drop_leaks(docs, both).collect()) == clean == sorted(set(range(docs.count())) - {d for d, *_ in whole})


def test_items_of_equal_text_are_all_reported(spark):
    texts, table = items(spark, 6)
    docs = helpers.documents(spark, [*texts, "no item"])
    copies = table.union(spark.createDataFrame([(50 + k, texts[2]) for k in range(20)] + [(None, texts[3])], "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, copies).collect()} == {
        *((k, k) for k in range(6)), *((2, 50 + k) for k in range(20)), (3, None)}


@pytest.mark.parametrize("threshold", [0.02, 0.2, 0.5])
def test_block_max_search_equals_all_scores(threshold):
    rng = random.Random(1)
    texts = [helpers.prose(rng, rng.randrange(1, 40), 60) for _ in range(70)]
    df = {}
    for t in texts:
        for w in set(decontaminate.words(t)):
            df[w] = df.get(w, 0) + 1
    index = decontaminate.Index([(str(k), t) for k, t in enumerate(texts)], df, 70, 20.0)
    none = len(index.term)
    queries = [rng.sample(range(none), rng.randrange(0, 26)) for _ in range(50)]
    scores = [[sum(index.gain[k] for t in q for k in range(index.start[t], index.start[t + 1]) if index.item[k] == i) for i in range(70)] for q in queries]
    terms = np.array([q + [none] * (26 - len(q)) for q in queries])
    got = {(q, i): s for q, i, s in zip(*(c.tolist() for c in index.search(terms, threshold)), strict=True)}
    assert set(got) == {(q, i) for q in range(50) for i in range(70) if scores[q][i] >= threshold - 1e-9} and len(got) > 20
    assert all(abs(s - scores[q][i]) < 1e-9 for (q, i), s in got.items())


def test_no_items_and_no_texts(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    blank = spark.createDataFrame([(1, None), (2, ""), (3, "...")], "item_id long, text string")
    docs = helpers.documents(spark)
    for t in (none, blank):
        assert decontaminate.find_leaks(docs, t).count() == 0
        assert decontaminate.drop_leaks(docs, t).count() == docs.count()
    assert decontaminate.find_leaks(helpers.documents(spark, []), items(spark)[1]).count() == 0
