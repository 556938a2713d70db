"""Data-quality jobs for the warehouse contract (V1–V4) and the reject log (D3).

Spark does not enforce primary keys, NOT NULL or varchar limits on files, so each is a
distributed job whose output is the list of violations (empty when the table is clean).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import Spec, to_struct
from ..operators.setops import DEFAULT_CHUNK_ROWS, bag_difference, replicate


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """V1 — key values that occur more than once, with their count ``n``.

    A partial aggregate counts each key inside every map task first, so a key holding a
    third of the rows reaches the shuffle as one row per task.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """V2 — NULL count of each column (``nulls_<col>``) and the row count, one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).cast("long").alias(f"nulls_{c}") for c in columns],
    )


def length_violations(df: DataFrame, limits: Mapping[str, int], table: str) -> DataFrame:
    """V3 — per limited column: longest value, the limit and the number of longer values."""
    aggs = []
    for c, limit in limits.items():
        ln = F.char_length(F.col(c))
        aggs += [F.max(ln).alias(f"max_{c}"), F.count_if(ln > limit).cast("long").alias(f"over_{c}")]
    summary = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.lit(limit).alias("max_allowed"),
            F.col(f"max_{c}").alias("max_length"),
            F.col(f"over_{c}").alias("violations"),
        )
        for c, limit in limits.items()
    ]
    return summary.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def conform(df: DataFrame, contract: Spec) -> DataFrame:
    """V4 — the contract's columns, in its order, cast to its types (ANSI casts fail loudly)."""
    struct = to_struct(contract)
    missing = [f.name for f in struct.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing contract columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in struct.fields])


def contract_mismatches(df: DataFrame, contract: Spec) -> list[str]:
    """Differences between a table's layout and its contract (names, order, types)."""
    want = to_struct(contract)
    problems = []
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    need = [(f.name, f.dataType.simpleString()) for f in want.fields]
    if [n for n, _ in have] != [n for n, _ in need]:
        problems.append(f"columns {[n for n, _ in have]} != {[n for n, _ in need]}")
    for (hn, ht), (nn, nt) in zip(have, need):
        if hn == nn and ht != nt:
            problems.append(f"{hn}: {ht} != {nt}")
    return problems


REPORT_COLUMNS = ("table_name", "check_name", "subject", "violations")


def contract_report(df: DataFrame, table: str, contract: Spec, keys: Sequence[str],
                    max_length: Mapping[str, int] | None = None) -> DataFrame:
    """V1–V3 for one table as rows ``(table_name, check_name, subject, violations)``.

    One pass: rows are grouped by the key with their count, NULLs in the contract's NOT
    NULL columns and over-length values (partial aggregation first), and the groups are
    summed up.
    """
    struct = to_struct(contract)
    required = [f.name for f in struct.fields if not f.nullable]
    limits = dict(max_length or {})
    found = [("not_null", c, F.count_if(F.col(c).isNull())) for c in required]
    found += [(f"max_length_{n}", c, F.count_if(F.char_length(F.col(c)) > n)) for c, n in limits.items()]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[v.alias(f"__v{i}") for i, (_, _, v) in enumerate(found)])
    totals = groups.agg(F.count_if(F.col("__n") > 1).alias("__dups"),
                        *[F.coalesce(F.sum(f"__v{i}"), F.lit(0)).alias(f"__v{i}") for i in range(len(found))])
    values = [(check, c, F.col(f"__v{i}")) for i, (check, c, _) in enumerate(found)] + [("unique_key", ",".join(keys), F.col("__dups"))]
    rows = [F.struct(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), F.lit(subject).alias("subject"),
                     v.cast("long").alias("violations")) for check, subject, v in values]
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def rejected_rows(raw: DataFrame, clean: DataFrame, *, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """D3 — rows of the raw (inferred) read that did not reach the clean output.

    A bag difference: rows removed by the not-null filter, surplus copies removed by the
    de-duplication and rows that failed to parse all count. Columns are aligned by
    position with ``larder.operators.setops.align_types``.
    """
    return bag_difference(raw, clean, chunk_rows=chunk_rows)


REASON_COLUMN = "reason"
RAW_LINE_COLUMN = "raw_line"


def rejects_with_reason(df: DataFrame, not_null_columns: Sequence[str] = (), *, corrupt_column: str | None = None,
                        chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """D3, reasoned: every row that the reader or the silver transform (not-null filter, then
    whole-row de-duplication) could not take over as it was, with why.

    ``malformed`` for a row whose line did not fit the schema (``corrupt_column`` of the read
    holds that line, returned as ``raw_line``), ``null:<column>`` for a row removed by the
    filter (first NULL column in order), ``duplicate`` for each surplus copy of a kept row.
    Copies are counted with one partial + final aggregate over one scan and regenerated with
    ``replicate``, so a row repeated a billion times is neither shipped whole through the
    shuffle nor re-expanded by one task.
    """
    cols = df.columns
    n = "__larder_n"
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(n))
    reason = F.lit("duplicate")
    copies = F.col(n) - 1
    tests = [(F.col(f"`{c}`").isNull(), f"null:{c}") for c in reversed(list(not_null_columns))]
    if corrupt_column:
        tests.append((F.col(f"`{corrupt_column}`").isNotNull(), "malformed"))
    for test, why in tests:
        reason = F.when(test, F.lit(why)).otherwise(reason)
        copies = F.when(test, F.col(n)).otherwise(copies)
    named = [F.col(f"`{c}`").alias(RAW_LINE_COLUMN if c == corrupt_column else c) for c in cols]
    tagged = counts.select(*named, reason.alias(REASON_COLUMN), copies.alias(n))
    return replicate(tagged, n, chunk_rows=chunk_rows)
