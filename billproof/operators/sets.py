"""Unions, priority unions and split-apply."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_strict(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by name; a missing or extra column is an error."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=False), dfs)


def priority_union(sources: Sequence[tuple[DataFrame, int]], key: str) -> DataFrame:
    """One row per key from several sources; the highest priority wins, ties go to the smallest row."""
    columns = sources[0][0].columns
    rest = [c for c in columns if c != key]
    tagged = [df.select(*columns).withColumn("_rank", F.lit(-priority)) for df, priority in sources]
    payload = F.struct(*[F.col(c) for c in rest])
    picked = union_strict(*tagged).groupBy(key).agg(F.min(F.struct("_rank", payload.alias("row"))).alias("_best"))
    return picked.select(key, *[F.col("_best.row")[c].alias(c) for c in rest]).select(*columns)


def distinct_keys(sources: Sequence[tuple[DataFrame, Column]], name: str) -> DataFrame:
    """Distinct non-NULL keys of several columns in several tables."""
    parts = [df.select(expr.alias(name)).where(F.col(name).isNotNull()) for df, expr in sources]
    return union_strict(*parts).distinct()


def split_apply(
    df: DataFrame, condition: Column, apply: Callable[[DataFrame], DataFrame], keep_null: bool = False
) -> DataFrame:
    """Rows with the condition pass unchanged; `apply` runs on the others; both are united.

    A NULL condition falls out of both sides, as with the two filters of the original jobs; keep_null=True sends it
    to the processed side.
    """
    other = ~F.coalesce(condition, F.lit(False)) if keep_null else ~condition
    return union_strict(df.where(condition), apply(df.where(other)).select(*df.columns))
