"""Dataset preparation: names, duplicates, imputation, standardisation, exact stratified split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.columns import normalize_columns, snake_case
from ..functions.text import text_array
from ..operators.joins import cross_one_row
from ..operators.quality import require_columns
from ..operators.selection import at_rank, decoded, mark_first, ordered_code
from ..operators.windows import surrogate
from ..session import stored

def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians of any number of rows: radix selection, four counting passes for all columns at once.

    `df` is read once: equal values of a column become one saved row with their number, which the passes read. Only the one or
    two middle values of each column come to the driver.
    """
    if not columns:
        return {}
    one = [F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("double").alias("v")) for i, c in enumerate(columns)]
    values = df.select(F.explode(F.array(*one)).alias("v")).select("v.i", "v.v").where(F.col("v").isNotNull())
    counted = values.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    name = F.element_at(text_array(list(columns)), F.col("i") + 1)
    codes = stored(counted.select(name.alias("c"), ordered_code(F.col("v")).alias("code"), "n"), "values")

    def middle(sizes: DataFrame) -> DataFrame:
        n = F.col("_n")
        return sizes.select("c", F.explode(F.array_distinct(F.array(F.floor((n - 1) / 2), F.floor(n / 2)))).alias("_rank"))

    found = at_rank(codes, ["c"], "code", middle, "n").groupBy("c").agg(F.min("_code").alias("low"), F.max("_code").alias("high"))
    rows = found.select("c", ((decoded(F.col("low")) + decoded(F.col("high"))) / 2).alias("m")).collect()
    return dict.fromkeys(columns) | {r["c"]: r["m"] for r in rows}


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent text of each column (ties: smallest). One pass; values are counted before the shuffle."""
    if not columns:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]))
    counted = df.select(pairs.alias("p")).where(F.col("p.v").isNotNull()).groupBy(F.col("p.c").alias("c"), F.col("p.v").alias("v")).count()
    best = counted.groupBy("c").agg(F.min_by("v", F.struct(-F.col("count"), F.col("v"))).alias("v"))
    found = {r["c"]: r["v"] for r in best.collect()}  # one row per column
    return {c: found.get(c) for c in columns}


def impute(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """NULL numbers become the median, NULL categories the mode; columns without any value stay NULL.

    `df` is evaluated once and saved; the passes read the saved table.
    """
    df = stored(df, "impute")
    fill: dict[str, object] = {**exact_medians(df, numeric), **modes(df, categorical)}
    return df.select(
        *[
            F.coalesce(F.col(c).cast("double") if c in numeric else F.col(c), F.lit(fill[c])).alias(c)
            if fill.get(c) is not None
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population standard deviation; a constant column becomes 0."""
    if not columns:
        return df
    stats = df.agg(*[e for c in columns for e in (F.avg(c).alias(f"_m_{c}"), F.stddev_pop(c).alias(f"_s_{c}"))])
    scaled = {
        c: (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(F.lit(1.0))
        for c in columns
    }
    joined = cross_one_row(df, stats)
    return joined.select(*[scaled[c].alias(c) if c in scaled else F.col(f"`{c}`") for c in df.columns])


def quota_of(sizes: DataFrame, label: str | None, fraction: float) -> DataFrame:
    """label, _quota: ceil(fraction * n) rows in all, shared out to the labels (label, _n) by largest remainder."""
    share = F.col("_n") * F.lit(fraction)
    if label is None:
        return sizes.select(F.ceil(share).alias("_quota"))
    shares = sizes.select(label, "_n", F.floor(share).alias("_low"), F.round(share - F.floor(share), 9).alias("_part"))
    totals = shares.agg((F.ceil(F.sum("_n") * F.lit(fraction)) - F.sum("_low")).alias("_left"))
    turns = surrogate(shares.withColumn("_behind", -F.col("_part")), ["_behind", label], "_turn")
    extra = F.when(F.col("_turn") <= F.col("_left"), 1).otherwise(0)
    return cross_one_row(turns, totals).select(label, (F.col("_low") + extra).alias("_quota"))


def split_column(
    df: DataFrame, label: str | None, fraction: float, seed: int, key: Sequence[str] | None = None, name: str = "_test"
) -> DataFrame:
    """df with a boolean column that marks ceil(fraction * n) test rows, shared out to the labels by largest remainder.

    Rows are ordered by a seeded hash of `key` (default: all columns). Each label's share ends at an exact order statistic
    of the hashes, found by counting passes over a saved copy of df; rows that tie there are told apart one by one.
    """
    place = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in key or df.columns])
    return mark_first(df, [] if label is None else [label], [place], lambda sizes: quota_of(sizes, label, fraction), name)


def stratified_split(
    df: DataFrame, label: str | None, fraction: float, seed: int, key: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(train, test), see split_column."""
    marked = split_column(df, label, fraction, seed, key)
    return marked.where("NOT _test").drop("_test"), marked.where("_test").drop("_test")


@dataclass(frozen=True)
class DatasetConfig:
    required_columns: Sequence[str] = field(default_factory=list)
    id_column: str | None = None
    target_column: str | None = None
    test_size: float = 0.2
    random_state: int = 42


def clean(df: DataFrame, config: DatasetConfig, keep_id: bool = False) -> DataFrame:
    """Names, required columns, duplicates, imputation, id dropped, numbers standardised (but not the target)."""
    named = require_columns(normalize_columns(df), [snake_case(c) for c in config.required_columns])
    target = snake_case(config.target_column) if config.target_column else None
    key = snake_case(config.id_column) if config.id_column else None
    unique = named.distinct()
    numeric = numeric_columns(unique)
    filled = impute(unique, [c for c in numeric if c != key], [c for c in unique.columns if c not in numeric and c != key])
    scaled = standardise(filled, [c for c in numeric if c not in (target, key)])
    return scaled.drop(key) if key and not keep_id else scaled


def marked(df: DataFrame, config: DatasetConfig) -> DataFrame:
    """The cleaned dataset with `_test`, stratified by the target where there is one.

    The id stays until the rows are assigned, so that equal feature rows are dealt out like any others.
    """
    cleaned = clean(df, config, keep_id=True)
    target = snake_case(config.target_column) if config.target_column else None
    found = split_column(cleaned, target if target in cleaned.columns else None, config.test_size, config.random_state)
    return found.drop(snake_case(config.id_column)) if config.id_column else found


def prepare(df: DataFrame, config: DatasetConfig) -> tuple[DataFrame, DataFrame]:
    """(train, test) of the cleaned dataset."""
    found = marked(df, config)
    return found.where("NOT _test").drop("_test"), found.where("_test").drop("_test")
