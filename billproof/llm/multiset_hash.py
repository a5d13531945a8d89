"""Document fingerprints: a homomorphic multiset hash in column functions.

A text is cut into pieces (paragraphs, and the sentences of a paragraph; the pieces joined give the text). Each piece is
hashed into a wide vector, and the fingerprint is the sum of the vectors modulo powers of two. So it doesn't depend on the
order of the pieces, and adding or subtracting a piece's vector inserts or deletes the piece.

The vector has 8 lanes of 32 random bits, summed modulo 2^32, which decide equality, and 128 lanes of one random bit,
summed modulo 2^32. With n pieces, twice such a sum less n is a sum of random signs; the squared length of the difference
of two such vectors estimates how many pieces two texts don't share, which gives their likeness. A sum never exceeds the
number of pieces, far below 2^32 in a text that a column can hold (2 GB), so the sums of whole texts are exact.

All work is done inside a row, so no piece is shuffled; a fingerprint is the text `hex(n) . wide lanes . bit lanes`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

WIDE = 4  # hashes of two 32-bit lanes each
SIGNS = 2  # hashes of 64 one-bit lanes each
BITS = 32
ROWS_PER_RANGE = 4096
# a piece ends behind a line break or behind a sentence's end and one white space
CUT = r"(?<=\n)|(?<=[.!?][ \t])"


def pieces(text: Column) -> Column:
    """The pieces of a text, none for an empty or null one."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), CUT), lambda p: p != "")


def _sum(hashes: Column, part) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda total, h: total + part(h))


def _hashes(found: Column, seed: int) -> Column:
    return F.transform(found, lambda p: F.xxhash64(F.lit(seed), p))


def with_lanes(df: DataFrame, text: str, to: str) -> DataFrame:
    """Add `to`: struct<n long, wide array<long>, bits array<long>>, the fingerprint of column `text`."""
    hashed = df.withColumn("_pieces", pieces(F.col(text)))
    names = [f"_h{i}" for i in range(WIDE + SIGNS)]
    # the seed is hashed first, so the lanes of one piece are independent
    hashed = hashed.withColumns({h: _hashes(F.col("_pieces"), i) for i, h in enumerate(names)})
    low, pair = F.lit(0xFFFFFFFF), F.lit(0x100000001)
    wide = [_sum(F.col(h), part).bitwiseAND(low) for h in names[:WIDE] for part in (lambda x: x.bitwiseAND(low), lambda x: F.shiftrightunsigned(x, 32))]
    sums = [_sum(F.col(h), lambda x, i=i: F.shiftrightunsigned(x, i).bitwiseAND(pair)) for h in names[WIDE:] for i in range(32)]  # two lanes a sum
    hashed = hashed.withColumns({"_n": F.size("_pieces").cast("long"), "_wide": F.array(*wide), "_sums": F.array(*sums)})
    part = F.lit((1 << BITS) - 1)
    bits = F.concat(F.transform("_sums", lambda s: s.bitwiseAND(part)), F.transform("_sums", lambda s: F.shiftrightunsigned(s, 32).bitwiseAND(part)))
    made = hashed.withColumn(to, F.struct(F.col("_n").alias("n"), F.col("_wide").alias("wide"), bits.alias("bits")))
    return made.drop("_pieces", "_n", "_wide", "_sums", *names)


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of a with the pieces of b inserted (sign 1) or deleted (sign -1)."""
    def lanes(name: str, power: int) -> Column:
        return F.zip_with(a[name], b[name], lambda x, y: F.pmod(x + sign * y, F.lit(1 << power)))

    return F.struct((a["n"] + sign * b["n"]).alias("n"), lanes("wide", 32).alias("wide"), lanes("bits", BITS).alias("bits"))


def as_text(lanes: Column) -> Column:
    def padded(values: Column, width: int) -> Column:
        return F.array_join(F.transform(values, lambda x: F.lpad(F.hex(x), width, "0")), "")

    return F.lower(F.concat_ws(".", F.hex(lanes["n"]), padded(lanes["wide"], 8), padded(lanes["bits"], BITS // 4)))


def likeness(a: Column, b: Column) -> Column:
    """1 - |a - b|^2 / (|a|^2 + |b|^2) of the sign vectors, within 0 and 1; 1 for equal fingerprints."""
    def square(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x)

    def signs(lanes: Column) -> Column:
        return F.transform(lanes["bits"], lambda x: (2 * x - lanes["n"]).cast("double"))

    x, y = signs(a), signs(b)
    apart = square(F.zip_with(x, y, lambda p, q: p - q))
    value = F.greatest(F.lit(0.0), 1 - apart / (square(x) + square(y)))
    return F.when(a["wide"] == b["wide"], 1.0).when((a["n"] == 0) | (b["n"] == 0), 0.0).otherwise(value)


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n (pieces), fingerprint string of each row; null texts count as empty, repeated rows give one row each."""
    rows = with_lanes(df.select(F.col(key).alias("key"), F.col(text).alias("_text")), "_text", "lanes")
    return rows.select("key", F.col("lanes.n").alias("n"), as_text(F.col("lanes")).alias("fingerprint"))


def edits(df: DataFrame, key: str = "doc_id", text: str = "text", rows: int = ROWS_PER_RANGE) -> DataFrame:
    """Fingerprints of each text, of its edited text, and how alike they are.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next row's
    text. Rows follow each other by descending key, null keys last, equal keys by text (null: empty); the last is followed
    by the first, a single row by itself. Columns: key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. Null texts count as empty; an empty table gives no rows; other columns aren't read.

    Rows are dealt into key ranges (one shuffle of the texts). The first row of the following range comes along as a guest,
    so no row needs a window over all rows. What the driver sees are the ranges' largest keys, 65,536 at the most.
    """
    base = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    bounds = common.range_bounds(base, "key", rows)
    at = common.below(bounds, F.col("key"))
    heads = base.groupBy(at.alias("range")).agg(F.max("key").alias("head")).orderBy("range").collect()
    follows = {h["head"]: heads[(i + 1) % len(heads)]["range"] for i, h in enumerate(heads)}  # whose guest a head is
    known = sorted(k for k in follows if k is not None)
    place = common.below(known, F.col("key")) - 1
    guest = F.when(F.get(common.constant(known or [0]), place) == F.col("key"), F.get(common.constant([follows[k] for k in known] or [0], "int"), place))
    if None in follows:
        guest = F.when(F.col("key").isNull(), F.lit(follows[None])).otherwise(guest)
    seats = F.array(F.struct(at.alias("range"), F.lit(0).alias("guest")), F.struct(guest.alias("range"), F.lit(1).alias("guest")))
    seated = base.withColumn("_seat", F.explode(F.filter(seats, lambda s: s["range"].isNotNull()))).select("key", "_text", "_seat.*")
    order = Window.partitionBy("range").orderBy("guest", F.col("key").desc_nulls_last(), "_text")
    own = with_lanes(seated.withColumn("_next", F.lead("_text").over(order)), "_text", "_own")
    own = own.withColumn("_after", F.lead("_own").over(order)).where("guest = 0")
    own = own.withColumn("n_chars", F.length("_text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.col("_text").substr(F.lit(1), (F.col("n_chars") - half).cast("int")), F.col("_next").substr(F.lit(1), half))
    made = with_lanes(own.withColumn("_edited", edited), "_edited", "_changed")
    return made.select(
        "key", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), as_text(F.col("_own")).alias("fingerprint"),
        as_text(F.col("_changed")).alias("edited_fingerprint"), likeness(F.col("_own"), F.col("_changed")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_after")).alias("near_next"),
    )
