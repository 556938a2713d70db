"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import functools
import gc
import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import scratch_path

#: Rows of an Arrow batch that one step of Python code holds as Python objects at a time.
SLICE_ROWS = 256
#: Text bytes of such a slice, unless one text is longer.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once for each Spark context (like --py-files)."""
    sc = spark.sparkContext
    if getattr(sc, "_larder_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="larder-py-"), os.path.basename(package))
    sc.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package)))
    sc._larder_shipped = True


def map_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` on executors that have this package."""
    ship(df.sparkSession)

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()  # the worker lives on with the next task

    return df.mapInArrow(tidy, schema)


def without_gc(work: Callable) -> Callable:
    """``work`` without the search for cycles, which makes none but millions of small objects."""

    @functools.wraps(work)
    def run(*args, **kw):
        on = gc.isenabled()
        gc.disable()
        try:
            return work(*args, **kw)
        finally:
            if on:
                gc.enable()

    return run


def fresh(columns: Iterable[str], base: str) -> str:
    """A column name starting with ``base`` that none of ``columns`` has in any case."""
    taken, name = {c.lower() for c in columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def slices(batch: pa.RecordBatch, column: str, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut a batch into pieces of bounded rows and, by ``column``'s lengths, bounded bytes."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin = held = 0
    for i, size in enumerate(lengths.tolist()):
        if i > begin and (i - begin >= rows or held + size > SLICE_BYTES):
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += size
    yield batch.slice(begin)


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if b is None else b for b in column.cast(pa.binary()).to_pylist()]


def runs(*keys: np.ndarray) -> np.ndarray:
    """Start positions of runs of equal keys in sorted arrays."""
    if not len(keys[0]):
        return np.zeros(0, dtype=np.int64)
    change = np.zeros(len(keys[0]), dtype=bool)
    change[0] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(change)
