"""K1 — published tables: written beside the current one, then switched by one log entry.

A static overwrite empties the folder first, so a job that fails midway leaves no table. Here
every write goes to a version folder of its own; the entry that names it is added to the table's
log only when the write has committed. Readers take the version of the last entry, so they see
the old rows or the new ones, never a part; a job killed at any point leaves the old rows, and its
folder is removed by ``expire``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..contracts import Spec
from ..sources.files import read_parquet
from ..storage import children, log_append, log_names, log_read, remove
from .files import write_parquet

LOG = "_log"
VERSION = "version-"


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the published version; None if nothing was published."""
    names = log_names(spark, f"{path.rstrip('/')}/{LOG}")
    return f"{path.rstrip('/')}/{log_read(spark, f'{path}/{LOG}', names[-1])}" if names else None


def publish(df: DataFrame, path: str, *, partition_by: str | Sequence[str] | None = None, sort_by: Sequence[str] = ()) -> str:
    """Write ``df`` as the table's next version and make it the current one; returns its folder.

    ``df`` may read the current version.
    """
    spark, name = df.sparkSession, f"{VERSION}{uuid.uuid4().hex}"
    write_parquet(df, f"{path.rstrip('/')}/{name}", mode="errorifexists", partition_by=partition_by, sort_by=sort_by)
    log_append(spark, f"{path.rstrip('/')}/{LOG}", name)
    return f"{path.rstrip('/')}/{name}"


def read_published(spark: SparkSession, path: str, schema: Spec | None = None) -> DataFrame:
    """The rows of the current version; an error if nothing was published."""
    folder = current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return read_parquet(spark, folder, schema)


def expire(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove the versions that are not among the last ``keep`` published ones (failed writes too).

    Not to be run beside a writer: its version is not published yet.
    """
    log = f"{path.rstrip('/')}/{LOG}"
    kept = {log_read(spark, log, n) for n in log_names(spark, log)[-keep:]}
    gone = [n for n in children(spark, path) if n.startswith(VERSION) and n not in kept]
    for n in gone:
        remove(spark, f"{path.rstrip('/')}/{n}")
    return gone
