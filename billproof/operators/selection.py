"""Exact order statistics of any number of rows: radix selection over 64-bit codes.

A pass counts the rows of each group by the next 16 bits of their code, of those rows whose higher bits are known to be the
wanted ones; four passes fix the code at a given rank. A pass is one partially aggregated count of at most 65,536 digits for
each group and rank; no task sorts or holds a column. Groups and ranks stay in tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

DIGIT = 16
PASSES = 64 // DIGIT


def ordered_code(value: Column) -> Column:
    """A long that orders like the double: NULL for NULL, NaN above all numbers, -0.0 equal to 0.0.

    The bits of a double are its exponent and mantissa side by side; scaling by powers of two is exact.
    """
    x = value.cast("double")
    size = F.abs(x)
    two = F.lit(2.0)
    guess = F.greatest(F.floor(F.log2(size)), F.lit(-1022))
    power = guess + F.when(F.pow(two, guess.cast("double")) > size, -1).when(F.pow(two, (guess + 1).cast("double")) <= size, 1).otherwise(0)
    exponent = F.greatest(power, F.lit(-1022))
    # size / 2^exponent * 2^52 in steps that neither overflow nor lose bits
    half = F.floor(exponent / 2)
    mantissa = size * F.pow(two, (-half).cast("double")) * F.pow(two, (half - exponent + 52).cast("double"))
    hidden = F.lit(1 << 52)
    normal = (exponent + 1022) * hidden + mantissa.cast("long")  # a subnormal has exponent -1022 and a mantissa below 2^52
    code = F.when(size == 0, F.lit(0)).when(size == float("inf"), F.lit(2047 << 52)).otherwise(normal)
    return F.when(F.isnan(x), F.lit((2047 << 52) + 1)).when(x.isNotNull(), F.when(x < 0, -code).otherwise(code))


def decoded(code: Column) -> Column:
    """The double that a code stands for."""
    size = F.abs(code)
    exponent = F.greatest(F.shiftright(size, 52), F.lit(1)).cast("long")
    mantissa = size - (exponent - 1) * F.lit(1 << 52)
    half = F.floor(exponent / 2)
    two = F.lit(2.0)
    value = mantissa.cast("double") * F.pow(two, (half - 538).cast("double")) * F.pow(two, (exponent - half - 537).cast("double"))
    whole = F.when(size > F.lit(2047 << 52), F.lit(float("nan"))).when(size == F.lit(2047 << 52), F.lit(float("inf"))).otherwise(value)
    return F.when(code.isNull(), F.lit(None).cast("double")).when((code < 0) & (size <= F.lit(2047 << 52)), -whole).otherwise(whole)


def _same(a: str, b: str, groups: Sequence[str]) -> Column:
    out = F.lit(True)
    for g in groups:
        out = out & F.col(f"{a}.`{g}`").eqNullSafe(F.col(f"{b}.`{g}`"))
    return out


def _join(left: DataFrame, right: DataFrame, condition: Column, groups: Sequence[str], how: str = "inner") -> DataFrame:
    """right has a row for each group and rank; without groups these are few and the join has no key."""
    return left.join(right if groups else F.broadcast(right), condition, how)


def at_rank(
    codes: DataFrame, groups: Sequence[str], code: str, ranks: Callable[[DataFrame], DataFrame], copies: str | None = None
) -> DataFrame:
    """groups, _rank, _code, _before, _equal: the code at each wanted rank (from 0) of each group, how many rows of the group
    have a smaller one and how many the same. Rows with a NULL code don't count.

    ranks: from (groups, _n: rows of the group) to distinct (groups, _rank); ranks outside the group are dropped. `codes` is read once
    a pass, so it should be a table rather than a long plan. copies: a column that says how many rows a row stands for.
    """
    groups = list(groups)
    bits = F.col(code).bitwiseXOR(F.lit(-(1 << 63)))  # unsigned order
    number = F.lit(1) if copies is None else F.col(f"`{copies}`")
    rows = codes.where(F.col(code).isNotNull()).select(*groups, bits.alias("_bits"), number.cast("long").alias("_copies"))
    many = F.count(F.lit(1)) if copies is None else F.sum("_copies")
    state = None
    for p in range(PASSES):
        shift = 64 - DIGIT * (p + 1)
        digit = F.shiftrightunsigned("_bits", shift).bitwiseAND(F.lit((1 << DIGIT) - 1)).cast("int")
        if state is None:
            counts = stored(rows.groupBy(*groups, digit.alias("_digit")).agg(many.alias("_m")), "digits")
            sizes = counts.groupBy(*groups).agg(F.sum("_m").alias("_n"))
            wanted = ranks(sizes).select(*groups, F.col("_rank").cast("long").alias("_rank"))
            wanted = _join(wanted.alias("w"), sizes.alias("z"), _same("w", "z", groups), groups).where("w._rank >= 0 AND w._rank < z._n")
            state = wanted.select("w.*", F.lit(0).cast("long").alias("_prefix"), F.lit(0).cast("long").alias("_before"))
            found = _join(counts.alias("c"), state.alias("s"), _same("c", "s", groups), groups).select("s.*", "c._digit", "c._m")
        else:
            met = _same("c", "s", groups) & (F.shiftrightunsigned("c._bits", shift + DIGIT) == F.col("s._prefix"))
            keys = [*groups, "_rank", "_prefix", "_before"]
            found = _join(rows.alias("c"), state.alias("s"), met, groups).select("s.*", digit.alias("_digit"), "c._copies").groupBy(*keys, "_digit").agg(many.alias("_m"))
        upto = Window.partitionBy(*groups, "_rank").orderBy("_digit")  # at most 65,536 digits
        placed = found.withColumn("_upto", F.col("_before") + F.sum("_m").over(upto))
        here = placed.where((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_m") <= F.col("_rank")))
        prefix = F.shiftleft("_prefix", DIGIT).bitwiseOR(F.col("_digit").cast("long"))
        state = here.select(*groups, "_rank", prefix.alias("_prefix"), (F.col("_upto") - F.col("_m")).alias("_before"), F.col("_m").alias("_equal"))
        state = stored(state, "ranks")
        if p < PASSES - 1:
            state = state.drop("_equal")
    return state.select(*groups, "_rank", F.col("_prefix").bitwiseXOR(F.lit(-(1 << 63))).alias("_code"), "_before", "_equal")


def mark_first(df: DataFrame, groups: Sequence[str], codes: Sequence[Column], quota: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """df with a boolean column: is the row among the first `_quota` of its group, ordered by the codes (longs, not NULL)?

    quota: from (groups, _n) to (groups, _quota). Rows that tie in one code are ordered by the next, and after the last by their
    place in the stored table, so exactly `_quota` rows are marked whatever the ties. df is written once and then read
    once a pass; the next code is looked at only where a tie has to be cut.
    """
    groups = list(groups)
    plain = [F.col(f"`{c}`") for c in df.columns]
    inner = [f"_g{i}" for i in range(len(groups))]
    ranked = [f"_c{i}" for i in range(len(codes))]
    rows = df.select(*plain, *[F.col(f"`{g}`").alias(i) for g, i in zip(groups, inner)], *[c.alias(r) for c, r in zip(codes, ranked)])
    rows = stored(rows.withColumn("_place", F.monotonically_increasing_id()), "marked")
    ranked.append("_place")

    def wanted(sizes: DataFrame) -> DataFrame:
        named = sizes.select(*[F.col(i).alias(g) for g, i in zip(groups, inner)], "_n")
        out = quota(named).select(*[F.col(f"`{g}`").alias(i) for g, i in zip(groups, inner)], (F.col("_quota") - 1).alias("_rank"))
        return out

    within, rest, cuts = rows, wanted, []
    for at, code in enumerate(ranked):
        cut = at_rank(within, inner, code, rest)
        cuts.append(cut)
        tied = cut.where(F.col("_before") + F.col("_equal") > F.col("_rank") + 1)
        if at + 1 == len(ranked) or tied.isEmpty():
            break
        left = stored(tied.select(*inner, F.col("_code").alias("_at"), (F.col("_rank") - F.col("_before")).alias("_rank")), "ties")
        within = _join(within.alias("r"), left.alias("t"), _same("r", "t", inner) & (F.col(f"r.{code}") == F.col("t._at")), inner).select("r.*")
        rest = lambda sizes, left=left: left.select(*inner, "_rank")
    out = rows
    for i, cut in enumerate(cuts):
        limit = cut.select(*inner, F.col("_code").alias(f"_t{i}"))
        out = _join(out.alias("o"), limit.alias("k"), _same("o", "k", inner), inner, "left").select("o.*", f"k._t{i}")
    # no threshold: nothing of the group is wanted; a tie without a further threshold is wanted whole
    mark = F.lit(True)
    for i in reversed(range(len(cuts))):
        own, limit = F.col(ranked[i]), F.col(f"_t{i}")
        mark = F.when(limit.isNull(), F.lit(i > 0)).when(own == limit, mark).otherwise(own < limit)
    return out.select(*plain, mark.alias(name))
