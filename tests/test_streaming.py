"""The daily feed as an availableNow stream: new days once, re-landed days replaced."""

from __future__ import annotations

import datetime as dt
import os
import shutil

import pytest

from larder import contracts
from larder.plans.feed import load_days, read_events
from larder.sinks import files as sinks
from larder.sources import manifest
from larder.streaming import feed


def _day(spark, d, ids):
    return spark.createDataFrame([(i, d) for i in ids], contracts.to_struct(contracts.BRONZE["out_of_stock"]))


def _silver(spark, path):
    return sorted(map(tuple, read_events(spark, path).collect()), key=str)


def test_stream_runs_pick_up_new_days_without_duplicates(spark, out):
    land, silver, ckpt = f"{out}/land", f"{out}/silver", f"{out}/ckpt"
    d1, d2, d3 = dt.date(2021, 1, 1), dt.date(2021, 1, 2), dt.date(2021, 1, 3)
    sinks.land_json_day(_day(spark, d1, [1, 1, 2]), land, d1)
    sinks.land_json_day(_day(spark, d2, [3]), land, d2)
    feed.run_feed_to_silver(spark, land, silver, ckpt)
    assert _silver(spark, silver) == sorted([(1, d1), (2, d1), (3, d2)], key=str)

    feed.run_feed_to_silver(spark, land, silver, ckpt)  # nothing new: unchanged
    assert _silver(spark, silver) == sorted([(1, d1), (2, d1), (3, d2)], key=str)

    sinks.land_json_day(_day(spark, d3, [4, 4]), land, d3)
    sinks.land_json_day(_day(spark, d2, [3, 5]), land, d2)  # day 2 re-landed with a new row
    feed.run_feed_to_silver(spark, land, silver, ckpt)
    assert _silver(spark, silver) == sorted([(1, d1), (2, d1), (3, d2), (4, d3), (5, d2)], key=str)


def test_days_split_over_micro_batches_stay_whole(spark, out):
    land, silver, ckpt = f"{out}/land", f"{out}/silver", f"{out}/ckpt"
    d = dt.date(2021, 2, 1)
    sinks.land_json_day(_day(spark, d, list(range(40))).repartition(4), land, d)
    feed.run_feed_to_silver(spark, land, silver, ckpt, max_files_per_trigger=1)
    assert len(_silver(spark, silver)) == 40


def test_late_undated_and_emptied_days(spark, out):
    land, silver, ckpt = f"{out}/land", f"{out}/silver", f"{out}/ckpt"
    d1, d2 = dt.date(2021, 1, 1), dt.date(2021, 1, 2)
    rows = lambda *r: spark.createDataFrame(list(r), "product_id int, date date")
    sinks.land_json_day(rows((1, d1), (2, None)), land, d1)
    feed.run_feed_to_silver(spark, land, silver, ckpt)
    sinks.land_json_day(rows((3, d2), (9, d1)), land, d2)
    feed.run_feed_to_silver(spark, land, silver, ckpt)
    assert _silver(spark, silver) == sorted([(1, d1), (2, None), (3, d2), (9, d1)], key=str)
    sinks.land_json_day(spark.createDataFrame([], "product_id int, date date"), land, d2)
    feed.run_feed_to_silver(spark, land, silver, ckpt)
    assert _silver(spark, silver) == sorted([(1, d1), (2, None)], key=str)


def _reference_day(path: str, text: str) -> None:
    """A day as the feed's loader lands it: one JSON array in ``<root>/<date>/data.json``."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_dated_layout_archived_and_empty_days(spark, out):
    land, silver, ckpt = f"{out}/land", f"{out}/silver", f"{out}/ckpt"
    d1, d2, d3 = (dt.date(2021, 1, k) for k in (1, 2, 3))
    run = lambda: feed.run_feed_to_silver(spark, land, silver, ckpt, layout="dated")
    _reference_day(f"{land}/{d1}/data.json", '[{"product_id": 1, "date": "2021-01-01"}, {"product_id": 2, "date": "2021-01-01"}]')
    _reference_day(f"{land}/{d2}/data.json", '[{"product_id": 3, "date": "2021-01-02"}, {"product_id": 9, "date": "2021-01-01"}]')
    run()
    both = [(1, d1), (2, d1), (9, d1), (3, d2)]
    assert _silver(spark, silver) == sorted(both, key=str)
    batch = f"{out}/batch"
    load_days(spark, land, [d1, d2], batch, layout="dated")
    assert _silver(spark, batch) == _silver(spark, silver)
    shutil.rmtree(f"{land}/{d1}")  # archived by retention
    _reference_day(f"{land}/{d3}/data.json", "[]")
    run()
    assert _silver(spark, silver) == sorted(both, key=str)
    # A day written again under its old path is seen once the manifest declares it.
    _reference_day(f"{land}/{d2}/data.json", "[]")
    manifest.declare(spark, land, {d2: 0})
    run()
    assert _silver(spark, silver) == sorted([(1, d1), (2, d1)], key=str)
    manifest.withdraw(spark, land, [d1])
    run()
    run()
    assert _silver(spark, silver) == []


def test_an_empty_array_in_a_new_file_empties_its_day(spark, out):
    land, silver, ckpt = f"{out}/land", f"{out}/silver", f"{out}/ckpt"
    d = dt.date(2021, 5, 1)
    _reference_day(f"{land}/day={d}/a.json", '[{"product_id": 1, "date": "2021-05-01"}]')
    feed.run_feed_to_silver(spark, land, silver, ckpt)
    assert _silver(spark, silver) == [(1, d)]
    os.remove(f"{land}/day={d}/a.json")
    _reference_day(f"{land}/day={d}/b.json", "[]")
    feed.run_feed_to_silver(spark, land, silver, ckpt)
    assert _silver(spark, silver) == []


def test_a_landing_cut_short_is_refused(spark, out):
    land, silver = f"{out}/land", f"{out}/silver"
    d = dt.date(2021, 6, 1)
    sinks.land_json_day(_day(spark, d, [1, 2]), land, d)
    load_days(spark, land, [d], silver)
    manifest.declare(spark, land, {d: 3})
    with pytest.raises(ValueError, match="has 2 of 3"):
        load_days(spark, land, [d], silver)
    assert len(_silver(spark, silver)) == 2
    manifest.declare(spark, land, {d: 2})
    load_days(spark, land, [d], silver)
    assert [tuple(r) for r in manifest.manifest(spark, land).collect()] == [(d, 2, "complete")]
