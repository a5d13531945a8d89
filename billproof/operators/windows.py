"""Ordered operators per key. First / last rows use aggregates, not windows, so hot keys stay cheap."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import pct_change
from ..session import cut_lineage
from .joins import skew_join
from .series import in_order


def first_last(
    df: DataFrame, keys: Sequence[str], order: str, first: Mapping[str, str], last: Mapping[str, str]
) -> DataFrame:
    """Values of the first and of the last row of each key in one aggregate; first / last: {column: output name}."""
    aggs = [F.min_by(F.col(c), F.col(order)).alias(name) for c, name in first.items()]
    aggs += [F.max_by(F.col(c), F.col(order)).alias(name) for c, name in last.items()]
    return df.groupBy(*keys).agg(*aggs)


def lag_change(
    df: DataFrame, keys: Sequence[str], order: str, value: str, previous: str, change: str, percent: str | None = None
) -> DataFrame:
    """Previous value, absolute and percent change per key. For one row per key and period, so groups are short."""
    w = Window.partitionBy(*keys).orderBy(order)
    out = df.withColumn(previous, F.lag(value).over(w)).withColumn(change, F.col(value) - F.col(previous))
    if percent:
        out = out.withColumn(percent, pct_change(F.col(value), F.col(previous)))
    return out


def worst_change(df: DataFrame, keys: Sequence[str], order: str, change: str) -> DataFrame:
    """Per key the row with the most negative change (ties: earliest period); keys without a fall are left out."""
    rest = [c for c in df.columns if c not in keys]
    falls = df.where(F.col(change) < 0)
    payload = F.struct(*[F.col(c) for c in rest])
    best = falls.groupBy(*keys).agg(F.min_by(payload, F.struct(F.col(change), F.col(order))).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def any_over(df: DataFrame, keys: Mapping[str, Column], condition: Column, name: str, yes: object, no: object) -> DataFrame:
    """Mark every row of a key when any of its rows satisfies the condition.

    keys: {helper name: expression}, NULL keys form a group of their own. An aggregate over the satisfying rows plus a
    skew-safe semi lookup instead of a window: a window would sort a hot key's rows in one task.
    """
    names = [f"_w{i}" for i in range(len(keys))]
    marks = [f"_n{i}" for i in range(len(keys))]
    typed = df.select(
        "*",
        *[F.coalesce(e.cast("string"), F.lit("")).alias(n) for n, e in zip(names, keys.values())],
        *[e.isNull().alias(m) for m, e in zip(marks, keys.values())],
    )
    hits = typed.where(condition).select(*names, *marks).distinct().withColumn("_hit", F.lit(True))
    out = skew_join(typed, hits, [*names, *marks], "left")
    flag = F.when(F.col("_hit"), F.lit(yes)).otherwise(F.lit(no)).alias(name)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], flag)


def dedup_latest(df: DataFrame, keys: Sequence[str], number: Column, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Per key the row with the highest valid number; missing or zero numbers come last.

    Spark limits each group inside the map tasks (window group limit), so hot keys do not travel.
    """
    w = Window.partitionBy(*keys).orderBy(
        F.when(number.isNull() | (number == 0), 1).otherwise(0).asc(), number.desc_nulls_last(), *tiebreak
    )
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def surrogate(df: DataFrame, order: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Consecutive numbers in global order without a one-task window.

    Rows are range-partitioned on the order columns, a hash of the row (which splits hot values) and the reading task
    (which splits masses of equal rows), pinned by a checkpoint so that a lost executor cannot change them, counted per
    range, then numbered inside each range.
    """
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    keyed = df.select("*", tie.alias("_tie"), F.spark_partition_id().alias("_task"))
    ranged = keyed.repartitionByRange(*[F.col(c) for c in order], F.col("_tie"), F.col("_task"))
    pinned = cut_lineage(ranged.withColumn("_range", F.spark_partition_id()))
    counts = pinned.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range: at most spark.sql.shuffle.partitions rows.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(*order, "_tie")
    numbered = pinned.withColumn("_rn", F.row_number().over(inside)).join(F.broadcast(offsets), "_range")
    return numbered.select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_rn") + F.col("_offset") + F.lit(start - 1)).cast("bigint").alias(name)
    )


def change_from_previous(value: str, digits: int = 1) -> Column:
    """Percent change against the value of `_prev` (see series.in_order), rounded; 0 after a zero."""
    before = F.col("_prev")[value]
    return F.coalesce(F.round((F.col(value) - before) / F.nullif(before, F.lit(0.0)) * F.lit(100.0), digits), F.lit(0.0))


def month_over_month(series: DataFrame, order: str, values: Mapping[str, str], digits: int = 1) -> DataFrame:
    """Percent change against the previous period of a series (one row per period), rounded; 0 after a zero.

    values: {column: output name}. The first period is left out. The series may have any length (see series.in_order).
    """
    rows = series.select(order, *[F.col(v).cast("double").alias(v) for v in values])
    pairs = in_order(rows, [], order, list(values)).where(F.col("_prev").isNotNull())
    return pairs.select(order, *[change_from_previous(v, digits).alias(name) for v, name in values.items()])


def worst_period(changes: DataFrame, order: str, value: str, period_name: str, value_name: str) -> DataFrame:
    """The period with the lowest change (ties: earliest); '-' and 0 for an empty series."""
    best = F.min(F.struct(F.col(value).alias("v"), F.col(order).alias("o")))
    return changes.agg(best.alias("b")).select(
        F.coalesce(F.col("b.o"), F.lit("-")).alias(period_name), F.coalesce(F.col("b.v"), F.lit(0.0)).alias(value_name)
    )


def split_mean_parts(order: str, cut: str, values: Mapping[str, str]) -> tuple[list[Column], list[Column]]:
    """(aggregates, columns over them) of split_mean."""
    o = F.col(order)
    aggs = [F.max(F.when(o == cut, 1).otherwise(0)).alias("_has"), F.max(F.when(o > cut, 1).otherwise(0)).alias("_after")]
    for v, name in values.items():
        c = F.col(v).cast("double")
        aggs += [F.avg(F.when(o <= cut, c)).alias(f"_pre_{name}"), F.avg(F.when(o > cut, c)).alias(f"_post_{name}")]
    usable = (F.col("_has") == 1) & (F.col("_after") == 1)
    out = []
    for name in values.values():
        pre, post = F.col(f"_pre_{name}"), F.col(f"_post_{name}")
        pct = F.when(pre != 0, (post - pre) / pre * F.lit(100.0)).otherwise(F.lit(0.0))
        parts = {f"pre_{name}": pre, f"post_{name}": post, f"pct_{name}": pct}
        out += [F.when(usable, e).otherwise(F.lit(0.0)).alias(n) for n, e in parts.items()]
    return aggs, out


def split_mean(series: DataFrame, order: str, cut: str, values: Mapping[str, str]) -> DataFrame:
    """Mean of each value up to the cut period and after it, and the percent change between the two.

    All results are 0 when the cut period is absent or is the last one.
    """
    aggs, out = split_mean_parts(order, cut, values)
    return series.agg(*aggs).select(*out)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Ordered top n; give a unique tiebreak as the last order column."""
    return df.orderBy(*order).limit(n)


def top_then_filter(df: DataFrame, order: Sequence[Column], n: int, condition: Column, m: int) -> DataFrame:
    """First the top n, then the rows of interest among them, then the first m of those."""
    return df.orderBy(*order).limit(n).where(condition).orderBy(*order).limit(m)
