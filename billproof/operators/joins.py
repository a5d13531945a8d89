"""Lookup-style joins that survive hot keys.

A small lookup side is left to Spark's own size-checked broadcast. A larger one is shuffled; rows with a NULL key, which
never match, are dealt over the reducers by their map task, and the partitions of hot keys are split by adaptive skew
handling or, where that is off or cannot apply because the result is grouped by the same key, by salting: hot rows are
dealt over salts and only the hot lookup rows are copied per salt.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is spread over salts. Hot keys are at most rows / HOT_ROWS, which bounds the salted copies.
HOT_ROWS = 5_000_000
SALTS = 64


def unique_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key, the smallest by `order` (default: all other columns), so that reruns agree.

    An aggregate, not a window: rows of a hot key are reduced before the shuffle.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    payload = F.struct(*[F.col(f"`{c}`") for c in rest])
    if order is None:
        best = F.min(payload)
    else:
        best = F.min_by(payload, F.struct(*order, payload))
    picked = df.groupBy(*keys).agg(best.alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def _hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    return df.groupBy(*keys).count().where(F.col("count") > hot_rows).drop("count").dropna(subset=list(keys))


def _adaptive_skew(df: DataFrame) -> bool:
    conf = df.sparkSession.conf
    return all(
        conf.get(key, "true").lower() == "true"
        for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    )


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    split: str = "auto",
    hot_source: DataFrame | None = None,
    hot_rows: int | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Equi join on same-named keys of a large left side with a right side that is unique per key.

    how: 'left', 'inner', 'left_semi' or 'left_anti'. NULL keys never match, as in a plain join.
    split: 'auto' leaves hot keys to adaptive skew handling when it is on, 'salt' always salts them (needed when the
    result is grouped by the same keys), 'none' is a plain join, for a left side with few rows per key. hot_source: where to
    count the keys, by default `left`; pass the base table when `left` is a long chain of joins, so that the count reads only
    the key columns.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"skew_join supports left-preserving joins, not {how!r}")
    keys = list(keys)
    if split == "none":
        return left.join(right, keys, how)
    if split == "auto" and _adaptive_skew(left):
        return _dealt_nulls_join(left, right, keys, how)
    salts = salts or SALTS
    hot = _hot_keys(left if hot_source is None else hot_source, keys, hot_rows or HOT_ROWS)
    flagged_hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    # The map task's id is the same when the task is retried, so a retried task sends its rows to the same salts.
    salt = F.when(F.col("_hot") | any_null, F.pmod(F.spark_partition_id(), F.lit(salts))).otherwise(F.lit(0))
    salted_left = left.join(flagged_hot, keys, "left").withColumn("_salt", salt).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_right = right.join(flagged_hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    joined = salted_left.join(salted_right, [*keys, "_salt"], how)
    return joined.select(*_result_columns(left, right, keys, how))


def _dealt_nulls_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """An equi join whose left rows with a NULL key, where they are kept, don't meet in one reducer.

    The join key is a struct of the keys and a number: 0, or for a NULL key one made of the map task and of the row's first
    other column, which a retried task repeats. Structs compare field by field, and no right row has a number but 0. The
    exchange by the struct stands right below the join, where adaptive skew handling looks for it.
    """
    kinds, others = dict(left.dtypes), dict(right.dtypes)
    if how not in ("left", "left_anti") or any(kinds[k] != others[k] for k in keys):
        return left.join(right, keys, how)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(f"`{k}`").isNull()
    own = [F.col(f"`{k}`") for k in keys]
    rest = [c for c in left.columns if c not in keys]
    plain = [c for c in rest if not kinds[c].startswith(("map", "array", "struct", "variant"))]
    spread = F.pmod(F.xxhash64(F.col(f"`{plain[0]}`")), F.lit(SALTS)) if plain else F.lit(0)
    number = F.when(any_null, F.spark_partition_id().cast("long") * SALTS + spread + 1).otherwise(0)
    dealt = left.select("*", number.alias("_dealt"))
    mine = dealt.select(*[F.col(f"`{c}`") for c in rest], F.struct(*own, F.col("_dealt")).alias("_key"))
    theirs = right.dropna(subset=keys).select(
        F.struct(*own, F.lit(0).cast("long").alias("_dealt")).alias("_key"), *[F.col(f"`{c}`") for c in right.columns if c not in keys]
    )
    joined = mine.join(theirs, "_key", how)
    added = [c for c in right.columns if c not in keys] if how == "left" else []
    return joined.select(*[F.col("_key")[k].alias(k) for k in keys], *[F.col(f"`{c}`") for c in [*rest, *added]])


def _result_columns(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> list[str]:
    columns = [*keys, *[c for c in left.columns if c not in keys]]
    if how in ("left", "inner"):
        columns += [c for c in right.columns if c not in keys]
    return [f"`{c}`" for c in columns]


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    fields: Mapping[str, str],
    hot_base: DataFrame | None = None,
    **skew,
) -> DataFrame:
    """Left join to a lookup reduced to one row per key.

    on: {column of df: column of dim}; fields: {column of dim: output name}. The row count of df never changes.
    hot_base: the table before earlier lookups, where hot keys are counted if they have to be.
    """
    keys = {f"_k{i}": (mine, theirs) for i, (mine, theirs) in enumerate(on.items())}
    side = dim.select(
        *[F.col(theirs).alias(k) for k, (_, theirs) in keys.items()],
        *[F.col(source).alias(target) for source, target in fields.items()],
    ).dropna(subset=list(keys))
    own = [F.col(mine).alias(k) for k, (mine, _) in keys.items()]
    source = None if hot_base is None else hot_base.select(*own)
    return skew_join(
        df.select("*", *own), unique_by(side, list(keys)), list(keys), "left", hot_source=source, **skew
    ).drop(*keys)


def lookup_cascade(
    df: DataFrame,
    dim: DataFrame,
    tries: Sequence[tuple[str, str]],
    fields: Mapping[str, str],
    matched: str | None = None,
    **skew,
) -> DataFrame:
    """Try several (df column, dim column) keys in order; each field takes the first non-NULL answer.

    matched: optional name of a column with the 1-based number of the first try that found a row.
    """
    kinds = dict(dim.dtypes)
    if len({mine for mine, _ in tries}) == 1 and len({kinds[theirs] for _, theirs in tries}) == 1:
        out = _lookup_tries(df, dim, tries, fields, **skew)
    else:
        out = df
        side = dim.withColumn("_found", F.lit(True))
        for i, (mine, theirs) in enumerate(tries):
            renamed = {source: f"_c{i}_{target}" for source, target in fields.items()} | {"_found": f"_c{i}_found"}
            out = lookup(out, side, {mine: theirs}, renamed, hot_base=df, **skew)
    columns = [F.col(f"`{c}`") for c in df.columns]
    for target in fields.values():
        columns.append(F.coalesce(*[F.col(f"_c{i}_{target}") for i in range(len(tries))]).alias(target))
    if matched:
        hit = F.coalesce(*[F.when(F.col(f"_c{i}_found"), F.lit(i + 1)) for i in range(len(tries))])
        columns.append(hit.alias(matched))
    return out.select(*columns)


def _lookup_tries(df: DataFrame, dim: DataFrame, tries: Sequence[tuple[str, str]], fields: Mapping[str, str], **skew) -> DataFrame:
    """The answers of all tries of one column of df, by one join: dim has a row for each try, reduced to one row per key."""
    answer = F.struct(*[F.col(f"`{source}`").alias(target) for source, target in fields.items()], F.lit(True).alias("found"))
    rows = F.array(*[F.struct(F.col(f"`{theirs}`").alias("k"), F.lit(i).alias("i")) for i, (_, theirs) in enumerate(tries)])
    long = dim.select(F.explode(rows).alias("_t"), answer.alias("_a")).select(F.col("_t.k").alias("_k0"), F.col("_t.i").alias("_i"), "_a")
    best = [F.min(F.when(F.col("_i") == i, F.col("_a"))).alias(f"_a{i}") for i in range(len(tries))]
    wide = long.where(F.col("_k0").isNotNull()).groupBy("_k0").agg(*best)
    names = [*fields.values(), "found"]
    side = wide.select("_k0", *[F.col(f"_a{i}")[n].alias(f"_c{i}_{n}") for i in range(len(tries)) for n in names])
    own = F.col(f"`{tries[0][0]}`").alias("_k0")
    return skew_join(df.select("*", own), side, ["_k0"], "left", hot_source=df.select(own), **skew).drop("_k0")


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """All columns renamed with a prefix, so that one lookup can play several roles."""
    return df.select(*[F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def keep_existing(df: DataFrame, keys: DataFrame, on: Mapping[str, str], **skew) -> DataFrame:
    """Rows whose key exists in `keys` (semi join)."""
    return _existence(df, keys, on, "left_semi", **skew)


def keep_missing(df: DataFrame, keys: DataFrame, on: Mapping[str, str], **skew) -> DataFrame:
    """Rows whose key does not exist in `keys` (anti join); NULL keys are kept."""
    return _existence(df, keys, on, "left_anti", **skew)


def _existence(df: DataFrame, keys: DataFrame, on: Mapping[str, str], how: str, **skew) -> DataFrame:
    names = {f"_k{i}": pair for i, pair in enumerate(on.items())}
    right = keys.select(*[F.col(theirs).alias(k) for k, (_, theirs) in names.items()]).dropna().distinct()
    left = df.select("*", *[F.col(mine).alias(k) for k, (mine, _) in names.items()])
    return skew_join(left, right, list(names), how, **skew).drop(*names)


def flag_exists(df: DataFrame, keys: DataFrame, on: Mapping[str, str], name: str, **skew) -> DataFrame:
    """TRUE / FALSE column: does the row's key exist in `keys`?"""
    side = keys.select(*on.values()).distinct().withColumn("_yes", F.lit(True))
    out = lookup(df, side, on, {"_yes": "_found"}, **skew)
    return out.withColumn(name, F.coalesce(F.col("_found"), F.lit(False))).drop("_found")


# Bits of a mark table: 32 MB at most.
MOST_MARKS = 1 << 28


def code_marks(codes: DataFrame, column: str) -> Callable[[DataFrame, Column, str], DataFrame]:
    """A test of 64-bit hashes against those in `codes`, however many, by a broadcast table of at most MOST_MARKS bits.

    The test adds a boolean column to a table. It is TRUE for every hash in `codes` and for a few others, some four percent of
    them with eight bits a hash and more beyond that, so it is for a first sorting out that moves no row.
    """
    bits = max(10, min(MOST_MARKS.bit_length() - 1, (8 * codes.count()).bit_length()))

    def places(code: Column) -> list[Column]:
        return [F.shiftrightunsigned(code, 64 - bits), code.bitwiseAND(F.lit((1 << bits) - 1))]

    def word(place: Column) -> Column:
        return F.shiftright(place, 6).cast("int")

    def bit(place: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))

    place = F.col("_place")
    found = codes.select(F.explode(F.array(*places(F.col(f"`{column}`")))).alias("_place")).groupBy(word(place).alias("_word"))
    words = found.agg(F.bit_or(bit(place)).alias("_bits")).toArrow()
    marks = np.zeros((1 << bits) >> 6, np.int64)
    marks[words["_word"].to_numpy()] = words["_bits"].to_numpy()
    offsets = pa.array([0, len(marks)], pa.int32())
    one = codes.sparkSession.createDataFrame(pa.table({"_marks": pa.ListArray.from_arrays(offsets, pa.array(marks))}))

    def among(df: DataFrame, code: Column, name: str) -> DataFrame:
        marked = F.lit(True)
        for p in places(code):
            marked = marked & (F.get("_marks", word(p)).bitwiseAND(bit(p)) != 0)
        return df.crossJoin(F.broadcast(one)).withColumn(name, marked).drop("_marks")

    return among


def join_by_branch(left: DataFrame, right: DataFrame, branches: Sequence[tuple[Column, str, str]], how: str = "inner") -> DataFrame:
    """Join whose key depends on a condition of the left row: one equi join per branch, then union.

    branches: (condition on left, left column, right column). Conditions must exclude each other; a left join keeps
    rows that match no condition too. The OR form of this join would compare every pair.
    """
    parts = []
    seen = F.lit(False)
    for condition, mine, theirs in branches:
        side = left.where(condition)
        parts.append(side.join(right, side[mine] == right[theirs], how))
        seen = seen | F.coalesce(condition, F.lit(False))
    if how == "left":
        rest = left.where(~seen)
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
        parts.append(rest.select("*", *nothing))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def cross_one_row(df: DataFrame, row: DataFrame, strict: bool = False) -> DataFrame:
    """Attach the values of a one-row table to every row.

    An empty `row` empties the result; with strict=True the rows stay and the attached columns are NULL. A second row
    fails the query.
    """
    found = row.agg(F.count(F.lit(1)).alias("n"), F.first(F.struct(*[F.col(f"`{c}`") for c in row.columns])).alias("r"))
    single = F.when(F.col("n") > 1, F.raise_error(F.lit("more than one row to attach")).cast("boolean")).otherwise(F.col("n") == 1)
    one = F.broadcast(found.where(single).select("r.*"))
    if strict:
        return df.join(one, F.lit(True), "left")
    return df.crossJoin(one)


def assemble(base: DataFrame, key: str, parts: Sequence[DataFrame], fill: Mapping[str, object]) -> DataFrame:
    """Left-join per-key aggregates onto a base and fill what is missing."""
    out = base
    for part in parts:
        out = out.join(part, key, "left")
    return out.select(
        *[
            F.coalesce(F.col(f"`{c}`"), F.lit(fill[c])).alias(c) if c in fill else F.col(f"`{c}`")
            for c in out.columns
        ]
    )


def valid_codes(df: DataFrame, column: str, codes: Sequence[str], name: str) -> DataFrame:
    """TRUE where the code is in a fixed list, FALSE otherwise (also for NULL)."""
    return df.withColumn(name, F.coalesce(F.col(column).isin(*codes), F.lit(False)))
