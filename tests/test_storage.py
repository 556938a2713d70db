"""Shared-folder resolution, scratch folders and the small-files session."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from larder import storage
from larder.sessionconf import MIN_PARTITION_CONF, small_files_session
from larder.sinks import files as sinks


def test_shared_root_and_scratch_paths(spark):
    root = storage.shared_root(spark)
    assert root and not root.endswith("/")
    configured = spark.conf.get(storage.CHECKPOINT_CONF, None)
    if configured:
        assert root == configured.rstrip("/")
    a, b = storage.scratch_path(spark, "x"), storage.scratch_path(spark, "x")
    assert a != b and a.startswith(f"{root}/larder/x/")


def test_no_private_folder_off_local_mode(spark, monkeypatch):
    monkeypatch.setattr(storage, "CHECKPOINT_CONF", "spark.larder.no.such.setting")
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    for master in ("local-cluster[2,1,1024]", "spark://host:7077", "yarn"):
        monkeypatch.setattr(spark.sparkContext, "master", master)
        with pytest.raises(RuntimeError, match="share"):
            storage.shared_root(spark)


def test_scratch_is_removed_when_done(spark):
    path = storage.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert storage.exists(spark, path)
    assert storage.clear_scratch(spark) >= 1
    assert not storage.exists(spark, path) and storage.children(spark, path) == []


def test_small_files_session_leaves_the_shared_session_alone(spark):
    before = spark.conf.get(MIN_PARTITION_CONF)
    own = small_files_session(spark)
    assert own.conf.get(MIN_PARTITION_CONF) == "1k" and spark.conf.get(MIN_PARTITION_CONF) == before
    assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert small_files_session(own) is own


def test_partitioned_write_has_no_checksum_files(spark, out):
    rows = [(k, k % 20) for k in range(200)] + [(200, None)]
    df = spark.createDataFrame(rows, "a int, store_id int")
    for _ in range(2):  # the second one replaces the first
        sinks.write_parquet(df, f"{out}/t", partition_by="store_id")
    folders = glob.glob(f"{out}/t/store_id=*")
    assert len(folders) == 21 and all(n.endswith(".parquet") for f in folders for n in os.listdir(f))
    assert sorted(map(tuple, spark.read.parquet(f"{out}/t").collect()), key=str) == sorted(rows, key=str)
    sinks.write_parquet(df.where("store_id = 3"), f"{out}/t", partition_by="store_id", dynamic=True)
    assert spark.read.parquet(f"{out}/t").count() == len(rows)


def test_a_set_local_file_system_is_kept(spark):
    conf = spark._jsc.hadoopConfiguration()
    assert storage.plain_local_files(spark)
    conf.set(storage.LOCAL_FS_CONF, "org.apache.hadoop.fs.LocalFileSystem")
    try:
        assert storage.plain_local_files(spark) == {}
    finally:
        conf.unset(storage.LOCAL_FS_CONF)


def test_small_writes_have_more_tasks_than_cores(spark, out):
    own = small_files_session(spark)
    cores = spark.sparkContext.defaultParallelism
    own.conf.set("spark.sql.shuffle.partitions", str(4 * cores))
    try:
        sinks.write_parquet(own.range(400_000).withColumn("k", F.col("id") % 1000), f"{out}/t", partition_by="k")
    finally:
        own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    files = glob.glob(f"{out}/t/k=*/*.parquet")
    tasks = {os.path.basename(f).split("-")[1] for f in files}
    assert len(files) == 1000 and len(tasks) > 2 * cores
