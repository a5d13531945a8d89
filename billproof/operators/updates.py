"""Table changes as DataFrame algebra: conditional update, upserts, schema evolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from .joins import skew_join
from .quality import assert_unique


def update_where(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Set columns where the condition is TRUE; other rows and columns stay."""
    return df.select(
        *[
            F.when(condition, changes[c]).otherwise(F.col(f"`{c}`")).alias(c) if c in changes else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], check: bool = True) -> DataFrame:
    """Rows of the source replace or extend the target. A duplicate source key is an error."""
    if check:
        assert_unique(source, keys, "upsert source")
    untouched = skew_join(target, source.select(*keys), keys, "left_anti").select(*target.columns)
    return untouched.unionByName(source, allowMissingColumns=True)


def upsert_changed(
    target: DataFrame, source: DataFrame, keys: Sequence[str], hash_column: str, check: bool = True
) -> DataFrame:
    """Insert missing keys and update rows whose hash differs; equal rows keep the target's version.

    Adds _action: 'keep', 'update', 'insert' or 'none' (target row without a source row). A NULL hash on either side
    of a match does not update, as a comparison with NULL is not TRUE.
    """
    if check:
        assert_unique(source, keys, "upsert source")
    columns = target.columns
    rest = [c for c in columns if c not in keys]
    t = target.select(*keys, F.struct(*rest).alias("_t"), F.lit(True).alias("_in_t"))
    s = source.select(*keys, F.struct(*rest).alias("_s"), F.lit(True).alias("_in_s"))
    joined = t.join(s, list(keys), "full_outer")
    changed = F.col(f"_t.{hash_column}") != F.col(f"_s.{hash_column}")
    action = (
        F.when(F.col("_in_t").isNull(), "insert")
        .when(F.col("_in_s").isNull(), "none")
        .when(changed, "update")
        .otherwise("keep")
    )
    chosen = joined.withColumn("_action", action)
    from_source = F.col("_action").isin("insert", "update")
    return chosen.select(
        *[
            F.col(c) if c in keys else F.when(from_source, F.col("_s")[c]).otherwise(F.col("_t")[c]).alias(c)
            for c in columns
        ],
        "_action",
    )


def evolve(
    df: DataFrame,
    rename: Mapping[str, str] | None = None,
    drop: Sequence[str] = (),
    add: Mapping[str, DataType | str] | None = None,
) -> DataFrame:
    """Rename, drop and add columns; what is already done is skipped."""
    present = {a: b for a, b in (rename or {}).items() if a in df.columns and b not in df.columns}
    out = df.withColumnsRenamed(present) if present else df
    out = out.drop(*[c for c in drop if c in out.columns])
    new = {c: F.lit(None).cast(t) for c, t in (add or {}).items() if c not in out.columns}
    return out.select("*", *[e.alias(c) for c, e in new.items()])
