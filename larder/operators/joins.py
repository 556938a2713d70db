"""Lookup joins (J1, J2): enrich a table with attributes of a lookup table.

The join is a plain left equi-join: no size probe runs while the plan is built and no
broadcast is forced. The planner broadcasts the lookup if its files are below the
session's threshold, and adaptive execution switches to a broadcast when the lookup turns
out that small at run time; both know its real bytes, whatever its column types are. A
lookup that grew large stays a sort-merge join, with skewed keys split.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_lookup(df: DataFrame, lookup: DataFrame, on: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """Left outer equi-join of ``df`` with ``lookup``.

    ``on`` maps ``df`` key columns to lookup key columns; ``take`` maps lookup columns to
    output names. Only the key and taken columns of the lookup are read. Rows of ``df``
    without a match (or with a NULL key) keep NULL attributes; a key repeated in the
    lookup repeats the row (plain left-join semantics).
    """
    keys = {src: f"__larder_k{i}" for i, src in enumerate(on.values())}
    right = lookup.select(
        *[F.col(src).alias(alias) for src, alias in keys.items()],
        *[F.col(src).alias(out) for src, out in take.items()],
    )
    cond = reduce(lambda a, b: a & b, [df[left] == right[keys[key]] for left, key in on.items()])
    return df.join(right, cond, "left").drop(*keys.values())
