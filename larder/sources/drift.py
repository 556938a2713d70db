"""X2/S2 — CSV days whose headers differ: files are grouped by header and bound by name.

Binding by position shifts every value when a day adds, drops or moves a column. Here only the
header line of each file is looked at beforehand (on the driver, as listing is); files with one
header are read together with the contract's types at the header's places, contract columns that
a file lacks are NULL, columns it has besides are read past and reported.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import Spec, to_struct
from ..storage import children, first_line
from .files import CSV_DIALECT

REPORT = "file string, column string, change string"
ADDED, MISSING, MOVED, REPEATED = "added", "missing", "moved", "repeated"


def csv_files(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """The CSV files of the given files and snapshot folders, in order."""
    out = []
    for p in paths:
        inside = [n for n in children(spark, p) if n.endswith((".csv", ".csv.gz"))]
        whole = p.rstrip("/")
        out += [whole] if inside == [whole.rpartition("/")[2]] or not inside else [f"{whole}/{n}" for n in inside]
    return out


def headers(spark: SparkSession, paths: Iterable[str]) -> dict[str, tuple[str, ...]]:
    """The header of each file; an empty file has none."""
    found = {}
    for f in csv_files(spark, paths):
        line = first_line(spark, f)
        found[f] = tuple(next(csv.reader([line], quotechar=CSV_DIALECT["quote"], doublequote=True))) if line else ()
    return found


def drift_report(spark: SparkSession, paths: Iterable[str], schema: Spec) -> DataFrame:
    """(file, column, change): columns that a file has besides the contract's (added), twice (repeated),
    lacks (missing), or has in another order among the contract's (moved)."""
    names, rows = to_struct(schema).names, []
    for f, header in headers(spark, paths).items():
        if not header:
            continue
        rows += [(f, c, REPEATED) for c in dict.fromkeys(header) if header.count(c) > 1]
        rows += [(f, c, ADDED) for c in dict.fromkeys(header) if c not in names]
        rows += [(f, c, MISSING) for c in names if c not in header]
        shared = [c for c in dict.fromkeys(header) if c in names]
        rows += [(f, c, MOVED) for c, d in zip(shared, [c for c in names if c in shared], strict=True) if c != d]
    return spark.createDataFrame(rows, REPORT)


def read_csv_by_name(spark: SparkSession, paths: Iterable[str], schema: Spec, *, multiline: bool = False) -> DataFrame:
    """The rows of all files with the contract's columns, whatever the order of each file's.

    A contract column that a file has twice is an error: no rule says which one holds.
    """
    struct = to_struct(schema)
    of_header: dict[tuple[str, ...], list[str]] = {}
    for f, header in headers(spark, paths).items():
        if header:
            of_header.setdefault(header, []).append(f)
    parts = []
    for header, files in of_header.items():
        twice = [c for c in struct.names if header.count(c) > 1]
        if twice:
            raise ValueError(f"{files[0]} has {twice[0]} more than once")
        # Columns besides the contract's keep their place under a name that nothing asks for.
        fields = [T.StructField(c, struct[c].dataType) if c in struct.names else T.StructField(f"_besides_{k}", T.StringType()) for k, c in enumerate(header)]
        read = (spark.read.options(**CSV_DIALECT).option("enforceSchema", "true").option("multiLine", str(multiline).lower())
                .schema(T.StructType(fields)).csv(files))
        parts.append(read.select(*[F.col(f"`{f.name}`") if f.name in header else F.lit(None).cast(f.dataType).alias(f.name) for f in struct.fields]))
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], struct)
