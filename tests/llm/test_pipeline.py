from __future__ import annotations

import random

import corpus_pipeline
from larder.llm import queries
from tests.conftest import SF_SMOKE
from tests.llm import helpers


def planted(tmp_path, spark):
    """Tables with one clean text of each kind and cases for every stage."""
    rng = random.Random(12)
    item = helpers.prose(rng, 30, 2000) + ". " + helpers.prose(rng, 10, 2000) + "."
    passage = helpers.prose(rng, 60, 2000)
    texts = [helpers.prose(rng, 100, 2000) if k % 4 else " ".join(w + "***" for w in helpers.prose(rng, 80, 2000).split()) for k in range(300)]
    labels = [(k, int(bool(k % 4)), 0) for k in range(300)]
    clean = helpers.prose(rng, 90, 2000)
    texts += [clean, clean, helpers.prose(rng, 40, 2000) + " " + item + " " + helpers.prose(rng, 40, 2000),
              helpers.prose(rng, 50, 2000) + " " + passage, helpers.prose(rng, 50, 2000) + " " + passage + " " + helpers.prose(rng, 50, 2000), None, ""]
    docs = spark.createDataFrame([(k, t, "en", f"src{k % 3}", None if t is None else len(t)) for k, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return texts, passage


def test_stages_take_effect_and_leave_clean_rows(spark, tmp_path):
    texts, passage = planted(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, ids = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out{k}")
        docs = spark.read.parquet(f"{tmp_path}/out{k}")
        ids.append({r["doc_id"] for r in docs.select("doc_id").collect()})
        if k < 4:
            assert docs.columns == columns
        if k == 2:
            kept = {r["doc_id"]: r for r in docs.collect()}
    good = {k for k in range(300) if k % 4}
    assert good | {300, 302, 303, 304} <= ids[0] and not ids[0] & (set(range(300)) - good)
    assert good | {300, 302, 303, 304} <= ids[1] and 301 not in ids[1]
    assert ids[2] == ids[1] and passage in kept[303]["text"] and passage not in kept[304]["text"]
    assert kept[300]["text"] == texts[300] and all(r["n_chars"] == len(r["text"] or "") for r in kept.values() if r["text"])
    assert ids[3] == ids[2] - {302} and ids[4] == ids[3]


def test_run_equals_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF_SMOKE).collect()
    assert 0 < len(rows) <= 200 and all(len(r["ids_sha256"]) == 64 for r in rows)


def test_every_operator_is_registered():
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert all(isinstance(sql, str) and name in queries.QUERIES for name, sql in queries.ORACLE.items())
