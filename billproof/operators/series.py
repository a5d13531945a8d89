"""Rows of a series in order, with their index and the row before them, for series of any length.

Rows are range-partitioned by key and order and pinned; every range numbers its own rows, and carries its row count and last
row over to the next range of the same key. What a single task looks at is one range, or one row for each range of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def in_order(series: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], files: int | None = None) -> DataFrame:
    """keys, order, values, `_x` (0, 1, ... within the key) and `_prev` (struct of order and values of the row before, or NULL).

    Rows with the same order follow their values. files: the number of ranges, by default left to Spark.
    """
    keys, values = list(keys), list(values)
    rows = series.select(*keys, order, *values, F.spark_partition_id().alias("_task"))  # the task parts masses of equal rows
    by = [*keys, order, *values, "_task"]
    ranged = rows.repartitionByRange(files, *by) if files else rows.repartitionByRange(*by)
    pinned = stored(ranged.withColumn("_range", F.spark_partition_id()), "series")
    ends = pinned.groupBy("_range", *keys).agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct(order, *values, "_task")).alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_range")  # one row for each range of a key
    carried = ends.select(
        F.col("_range").alias("_r"),
        *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)],
        F.coalesce(F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.lag("_last").over(before).alias("_carried"),
    )
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}"))
    inside = Window.partitionBy("_range", *keys).orderBy(order, *values, "_task")
    row = F.struct(order, *values, "_task")
    numbered = pinned.withColumns({"_x": F.row_number().over(inside) - 1, "_prev": F.lag(row).over(inside)})
    joined = numbered.join(carried, same)
    prev = F.when(F.col("_x") == 0, F.col("_carried")).otherwise(F.col("_prev"))
    return joined.select(*keys, order, *values, (F.col("_x") + F.col("_offset")).cast("long").alias("_x"), prev.alias("_prev"))
