"""Projections, filters and de-duplication (P1–P6, A1–A2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_as(df: DataFrame, columns: Mapping[str, str | Column] | Sequence[str]) -> DataFrame:
    """P1/P2 — keep (and optionally alias) columns: ``{output_name: source_col_or_expr}``."""
    if isinstance(columns, Mapping):
        exprs = [(F.col(src) if isinstance(src, str) else src).alias(out) for out, src in columns.items()]
        return df.select(*exprs)
    return df.select(*columns)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """P3 — rename columns ``{old: new}`` in one projection."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"cannot rename missing columns {missing}")
    return df.withColumnsRenamed(dict(mapping))


def with_computed(df: DataFrame, keep: Sequence[str], computed: Mapping[str, Column]) -> DataFrame:
    """P4 — projection of kept columns plus computed ones."""
    return df.select(*keep, *[expr.alias(name) for name, expr in computed.items()])


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """P5 — drop rows where any of ``columns`` is NULL (pushed into the scan as IsNotNull)."""
    cond = None
    for c in columns:
        term = F.col(c).isNotNull()
        cond = term if cond is None else cond & term
    return df if cond is None else df.where(cond)


def identity(df: DataFrame) -> DataFrame:
    """P6 — pass-through."""
    return df


def dedup_rows(df: DataFrame) -> DataFrame:
    """A1 — whole-row de-duplication (NULLs compare equal).

    Planned as a partial + final hash aggregate: copies of one row collapse inside each
    map task before the shuffle, so a row repeated a billion times ships at most one copy
    per task.
    """
    return df.dropDuplicates()


def distinct(df: DataFrame) -> DataFrame:
    """A2 — distinct rows."""
    return df.distinct()
