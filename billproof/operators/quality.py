"""Data-quality checks. All checks of a table run in one scan and come back as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class EmptyStageError(RuntimeError):
    """A stage that must not be empty is empty."""


def check(df: DataFrame, violations: Mapping[str, Column]) -> DataFrame:
    """One row per check: name, number of violating rows, ok. NULL conditions do not violate."""
    counts = df.agg(*[F.count_if(cond).alias(name) for name, cond in violations.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in violations]))
    return counts.select(rows.alias("r")).select(
        "r.check", "r.violations", (F.col("r.violations") == 0).alias("ok")
    )


def parity(source: DataFrame, target: DataFrame, name: str = "row_count") -> DataFrame:
    """Row counts of two tables and whether they agree."""
    sides = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(target.select(F.lit(0).alias("s"), F.lit(1).alias("t")))
    counted = sides.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"), F.coalesce(F.sum("t"), F.lit(0)).alias("target_rows")
    )
    return counted.select(
        F.lit(name).alias("check"), "source_rows", "target_rows", (F.col("source_rows") == F.col("target_rows")).alias("ok")
    )


def schema_diff(df: DataFrame, expected: Sequence[str]) -> tuple[list[str], list[str]]:
    """(missing, extra) column names against an expected list. Metadata only."""
    have = set(df.columns)
    want = set(expected)
    return [c for c in expected if c not in have], [c for c in df.columns if c not in want]


def schema_check(df: DataFrame, expected: Sequence[str], exact: bool = False) -> bool:
    """Does the table hold the expected columns? exact=True also compares names, order and number."""
    if exact:
        return list(df.columns) == list(expected)
    return not schema_diff(df, expected)[0]


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing, _ = schema_diff(df, columns)
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    return df


def assert_not_empty(df: DataFrame, stage: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyStageError(f"stage {stage!r} has no rows")
    return df


def assert_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Raise when a key occurs twice; stops at the first duplicate found."""
    if not df.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"{what}: key {list(keys)} is not unique")
    return df


def all_ok(report: DataFrame) -> DataFrame:
    """One row: TRUE when every check of a report is ok."""
    return report.agg(F.bool_and("ok").alias("all_ok"))
