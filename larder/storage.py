"""Where the library may write intermediate tables, and the folders under it.

Intermediate and round-trip tables go under the shared folder the cluster names in
``spark.checkpoint.dir``: every executor can read it, so a lost executor's work is
recomputed or re-read instead of vanishing with a machine-local disk. Without the setting
a local session gets a folder of its own; any other session is refused, as a folder of the
driver's machine would scatter the table over the executors' disks.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
LOCAL_FS_CONF = "fs.file.impl"


def _is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        sc_dir = spark.sparkContext.getCheckpointDir()
        root = os.path.dirname(sc_dir) if sc_dir else None
    if not root:
        if not _is_local(spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        # Local or test session: pick a folder once; the context remembers it.
        root = tempfile.mkdtemp(prefix="larder-shared-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused directory under the shared root for one run of ``name``."""
    path = f"{shared_root(spark)}/larder/{name}/{uuid.uuid4().hex}"
    made = getattr(spark.sparkContext, "_larder_scratch", None)
    if made is None:
        made = spark.sparkContext._larder_scratch = []
    made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove all scratch directories this application made; results read from them are gone.

    A query's result may read its scratch tables lazily, so the caller decides when it is
    done with them (``bench.py`` and ``scripts/check_oracle.py``: after each query).
    """
    made = getattr(spark.sparkContext, "_larder_scratch", [])
    n = len(made)
    while made:
        remove(spark, made.pop())
    return n


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory, hidden ones (``_SUCCESS``, ``.crc``) left out; none if it is missing."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n for n in names if not n.startswith((".", "_")) or "=" in n)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Put a folder in the place of another."""
    fs, p = _fs(spark, path)
    _, t = _fs(spark, target)
    fs.delete(t, True)
    fs.mkdirs(t.getParent())
    if not fs.rename(p, t):
        raise RuntimeError(f"could not move {path} to {target}")


def plain_local_files(spark: SparkSession) -> dict[str, str]:
    """Writer options for a table of many small Parquet files on a local file system.

    Without its native libraries Hadoop starts a process for each permission it sets: five for a
    folder with a file and a checksum file, two without checksum files (Parquet pages hold their
    own checksums). Other file systems do not read these options; a cluster's own class for
    ``file:`` stays.
    """
    if spark._jsc.hadoopConfiguration().get(LOCAL_FS_CONF):
        return {}
    return {LOCAL_FS_CONF: "org.apache.hadoop.fs.RawLocalFileSystem", f"{LOCAL_FS_CONF}.disable.cache": "true"}


def _stream_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str, most: int = 1 << 16) -> str:
    """The first line of a text file, from at most ``most`` bytes of it."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        raw = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(
            spark._jvm.org.apache.commons.io.input.BoundedInputStream(stream, most)))
    finally:
        stream.close()
    return raw.split(b"\n")[0].decode("utf-8", "replace").rstrip("\r").removeprefix("\ufeff")


def log_names(spark: SparkSession, folder: str) -> list[str]:
    """Entries of a log folder in order."""
    return [n for n in children(spark, folder) if n.isdigit()]


def log_read(spark: SparkSession, folder: str, name: str) -> str:
    return _stream_text(spark, f"{folder.rstrip('/')}/{name}")


def log_append(spark: SparkSession, folder: str, text: str) -> str:
    """Add the next entry; it appears whole or not at all. Two writers at once: one of them fails."""
    names = log_names(spark, folder)
    name = f"{int(names[-1]) + 1 if names else 1:09d}"
    fs, p = _fs(spark, f"{folder.rstrip('/')}/{name}")
    _, beside = _fs(spark, f"{folder.rstrip('/')}/.{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(p) or not fs.rename(beside, p):
        fs.delete(beside, False)
        raise RuntimeError(f"another writer added {name} to {folder}")
    return name
