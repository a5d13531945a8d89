"""Aggregate building blocks. Everything here combines before the shuffle, so one hot group costs one row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import text_amount
from .series import in_order


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sum_where(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value))


def distinct_where(condition: Column, value: Column) -> Column:
    return F.count_distinct(F.when(condition, value))


def any_flag(condition: Column) -> Column:
    """1 when any row of the group satisfies the condition, else 0."""
    return F.max(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def text_sum(c: Column, to: str = "double") -> Column:
    """Sum of an amount held as text; blank, NULL and unreadable count as 0."""
    return F.sum(F.coalesce(text_amount(c, to), F.lit(0).cast(to)))


def set_text(c: Column, sep: str = " | ") -> Column:
    """Distinct values in sorted order as one text (for columns with few distinct values per group)."""
    return F.concat_ws(sep, F.array_sort(F.collect_set(c)))


def coverage(df: DataFrame, by: Sequence[str], filled: Mapping[str, Column], digits: int = 1) -> DataFrame:
    """Percent of rows per group in which each condition holds, plus the row count, in one scan."""
    parts = [F.round(F.count_if(cond) * F.lit(100.0) / F.count(F.lit(1)), digits).alias(name) for name, cond in filled.items()]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), *parts)


def overlap(df: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """Keys that occur with more than one member (e.g. one month billed by two systems), with the sorted members."""
    grouped = df.groupBy(*keys).agg(F.array_sort(F.collect_set(member)).alias("members"))
    return grouped.where(F.size("members") > 1)


def weighted_distinct(
    df: DataFrame, keys: Sequence[str], item: Column, weights: Mapping[str, int], default: int, name: str
) -> DataFrame:
    """Sum of item weights over the distinct items of each key. A NULL item counts once with the default weight."""
    weight = F.lit(default)
    for value, w in weights.items():
        weight = F.when(F.upper(F.trim(F.col("_item"))) == value, F.lit(w)).otherwise(weight)
    distinct = df.select(*keys, item.alias("_item")).distinct()
    return distinct.groupBy(*keys).agg(F.sum(weight).cast("int").alias(name))


def pivot_sum(
    df: DataFrame, keys: Sequence[str], column: str, values: Mapping[str, str], amount: Column
) -> DataFrame:
    """One column per listed value with the sum of the amount, 0 where there is none.

    Conditional sums in one aggregate: a single shuffle and no pass to discover the values.
    """
    zero = F.lit(0)
    parts = [F.coalesce(F.sum(F.when(F.col(column) == v, amount)), zero).alias(name) for v, name in values.items()]
    return df.groupBy(*keys).agg(*parts)


def summarise(df: DataFrame, label: str, aggs: Mapping[str, Column]) -> DataFrame:
    """Roll-up of a labelled table: one row per label."""
    return df.groupBy(label).agg(*[expr.alias(name) for name, expr in aggs.items()])


def grand_total(df: DataFrame, aggs: Mapping[str, Column]) -> DataFrame:
    """One-row totals, kept as a DataFrame."""
    return df.agg(*[expr.alias(name) for name, expr in aggs.items()])


def distribution(df: DataFrame, columns: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))


def ordered_distribution(df: DataFrame, column: str, order: Sequence[str], name: str = "volume") -> DataFrame:
    """Counts for a fixed list of categories, 0 for absent ones, with the position in the list."""
    spark = df.sparkSession
    wanted = spark.range(len(order)).select(
        F.col("id").cast("int").alias("position"),
        F.element_at(F.array(*[F.lit(v) for v in order]), F.col("id").cast("int") + 1).alias(column),
    )
    counts = df.where(F.col(column).isin(*order)).groupBy(column).agg(F.count(F.lit(1)).alias(name))
    return wanted.join(counts, column, "left").select(
        "position", column, F.coalesce(F.col(name), F.lit(0)).alias(name)
    )


def trend_parts(values: Mapping[str, str], index: Column) -> list[Column]:
    """Aggregates slope_<name> and r2_<name> of each value over the index."""
    x, aggs = index.cast("double"), []
    for v, name in values.items():
        y = F.col(v)
        fit = F.when(F.var_pop(y) > 0, F.coalesce(F.regr_r2(y, x), F.lit(0.0))).otherwise(F.lit(0.0))
        aggs += [F.coalesce(F.regr_slope(y, x), F.lit(0.0)).alias(f"slope_{name}"), F.round(fit, 3).alias(f"r2_{name}")]
    return aggs


def linear_trend(series: DataFrame, keys: Sequence[str], order: str, values: Mapping[str, str]) -> DataFrame:
    """Slope and R2 of each value over the consecutive index of `order` (0, 1, 2, ...), per key.

    The index comes from ordered ranges (see series.in_order) and the regression from mergeable sums, so a series may have
    any length. NULL values count as 0; R2 is 0 for a constant series.
    """
    rows = series.select(*keys, order, *[F.coalesce(F.col(v).cast("double"), F.lit(0.0)).alias(v) for v in values])
    flat = in_order(rows, keys, order, list(values))
    aggs = trend_parts(values, F.col("_x"))
    return flat.groupBy(*keys).agg(*aggs) if keys else flat.agg(*aggs)


def text_measures(text: Column, copies: Column) -> list[Column]:
    """Aggregates `_digest` and `_size` of a multiset of texts: sums of 64-bit hashes and of characters, so that they add up
    over any parts of it."""
    wide = "decimal(38,0)"
    return [
        F.coalesce(F.sum(F.xxhash64(text).cast("decimal(19,0)") * F.when(text.isNotNull(), copies).cast("decimal(18,0)")).cast(wide), F.lit(0).cast(wide)).alias("_digest"),
        F.coalesce(F.sum(F.length(text).cast("long") * copies), F.lit(0).cast("long")).alias("_size"),
    ]


def concat_parts(
    df: DataFrame,
    keys: Sequence[str],
    texts: Mapping[str, Column],
    sep: str = " | ",
    limit: int = 16_000_000,
    distinct: Sequence[str] = (),
    measured: str | None = None,
) -> DataFrame:
    """All texts of a group joined in sorted order, in parts of about `limit` characters.

    Texts named in `distinct` are listed once, the others as often as they occur. Rows: keys, `_part` (0, 1, ...), one
    text column per entry, `_parts` (number of parts of the key). A group with texts always has part 0, and one that fits,
    which is the normal case, has no other. Equal texts are counted before the shuffle; a huge group is
    dealt out over parts by the hash of the text, so no task ever holds it whole and nothing is dropped. measured: the
    column whose texts' digest and length are added (see text_measures).
    """
    keys = list(keys)
    kinds = list(texts)
    long = df.select(
        *keys, F.explode(F.array(*[F.struct(F.lit(k).alias("k"), t.alias("t")) for k, t in texts.items()])).alias("_e")
    ).select(*keys, F.col("_e.k").alias("_k"), F.col("_e.t").alias("_t"))
    counted = long.where(F.col("_t").isNotNull()).groupBy(*keys, "_k", "_t").agg(F.count(F.lit(1)).alias("_n"))
    if distinct:
        counted = counted.withColumn("_n", F.when(F.col("_k").isin(*distinct), F.lit(1)).otherwise(F.col("_n")))
    length = (F.length("_t") + len(sep)) * F.col("_n")
    sizes = counted.groupBy(*keys, "_k").agg(
        F.ceil(F.sum(length) / limit).cast("int").alias("_parts"), F.min(F.xxhash64("_t")).alias("_least")
    )
    big = sizes.where(F.col("_parts") > 1)
    same = [F.col(f"c.`{k}`").eqNullSafe(F.col(f"g.`{k}`")) for k in [*keys, "_k"]]
    parts = F.coalesce(F.col("g._parts"), F.lit(1))
    # Very many copies of one text are dealt out as well: each chunk of copies stays below the limit.
    chunks = F.greatest(F.lit(1), F.ceil((F.length("c._t") + len(sep)) * F.col("c._n") / limit)).cast("int")
    dealt = counted.alias("c").join(big.alias("g"), same, "left").select(
        *[F.col(f"c.`{k}`") for k in keys],
        F.col("c._k"),
        F.col("c._t"),
        F.col("c._n").alias("_copies"),
        parts.alias("_parts"),
        chunks.alias("_chunks"),
        (F.xxhash64("c._t") == F.col("g._least")).alias("_leads"),
        F.explode(F.sequence(F.lit(0), chunks - 1)).alias("_chunk"),
    )
    whole, extra = F.floor(F.col("_copies") / F.col("_chunks")), F.col("_copies") % F.col("_chunks")
    spread = dealt.select(
        *keys,
        "_k",
        "_t",
        (whole + F.when(F.col("_chunk") < extra, 1).otherwise(0)).alias("_n"),
        "_parts",
        F.when(F.col("_leads") & (F.col("_chunk") == 0), 0)
        .otherwise(F.pmod(F.xxhash64("_t") + F.col("_chunk"), F.col("_parts")).cast("int"))
        .alias("_part"),
    )

    def joined(kind: str) -> Column:
        mine = F.collect_list(F.when(F.col("_k") == kind, F.struct("_t", "_n")))
        repeated = F.transform(F.array_sort(mine), lambda p: F.array_repeat(p["_t"], p["_n"].cast("int")))
        return F.concat_ws(sep, F.flatten(repeated))

    measures = text_measures(F.when(F.col("_k") == measured, F.col("_t")), F.col("_n")) if measured else []
    return spread.groupBy(*keys, "_part").agg(*[joined(k).alias(k) for k in kinds], F.max("_parts").alias("_parts"), *measures)
