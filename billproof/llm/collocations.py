"""Phrase collocations by stripes: every prefix keys an associative counter of the words that follow it.

Counting. A task numbers the words of some million tokens and counts, for each prefix of 1 to longest - 1 words, the words
that come next (prefixes of one word also count "nothing follows", so that a stripe's total is the word's own count). The
stripes are sent as packed blocks, with their words as text, to cells; a cell merges its stripes elementwise. A stripe is
always dealt in SPLIT parts by its next words, so no frequent prefix is one key; a part holds whole counters, and prefix
totals are the sum over the parts. From the merged stripes come the extensions (phrases with their counts), the totals of
prefixes, and, from the stripes of longer prefixes, the greatest extension of each shorter phrase for the subsumption test.

Scoring. Counts are exact and words are never replaced by hashes. Every cut of a candidate looks the counts of its two parts
up by a join; the few phrases with a thousandth of all occurrences (at most a thousand for each length) are broadcast, so
that no join key is hot.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

BLOCK = 2_000_000  # tokens counted at a time; their numbers fit 21 bits
SPLIT = 16  # parts of each stripe
CELL_BYTES = 32 << 20  # text bytes a cell
HOT = 1000  # a phrase with this part of all occurrences is looked up by broadcast
BREAK = b"\xff"  # not in UTF-8
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9)


class Numbers(dict):
    """Word -> its number in order of first sight; 0 is the end of a piece."""

    def __init__(self) -> None:
        super().__init__({BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint32, len(words))


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased words, with BREAK where a piece ends."""
    return text.translate(FOLD).replace(b"\n", b" " + BREAK + b" ").split()


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ (b * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def summed(ids: list[np.ndarray], counts: np.ndarray | None, known: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of word numbers below `known`, in order, with summed counts (None: ones)."""
    n = len(ids[0])
    if not n:
        return ids, np.zeros(0, np.uint64)
    bits = np.uint64(max(1, (known - 1).bit_length()))
    if int(bits) * len(ids) > 64:
        order = np.lexsort(ids[::-1])
        ids = [x[order] for x in ids]
        new = np.flatnonzero(np.append(True, np.any([x[1:] != x[:-1] for x in ids], axis=0)))
        own = np.ones(n, np.uint64) if counts is None else counts[order]
        return [x[new] for x in ids], np.add.reduceat(own, new)
    key = ids[0].astype(np.uint64)
    for x in ids[1:]:
        key = (key << bits) | x
    if counts is None:
        key.sort()
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        total = np.diff(np.append(new, n)).astype(np.uint64)
    else:
        order = np.argsort(key)
        key = key[order]
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        total = np.add.reduceat(counts[order], new)
    key, mask, out = key[new], (np.uint64(1) << bits) - np.uint64(1), []
    for _ in ids:
        out.append((key & mask).astype(np.uint32))
        key = key >> bits
    return out[::-1], total


def narrow(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0), copy=False)


def pack(words: bytes, arrays: list[np.ndarray]) -> bytes:
    head = np.array([len(words), *(len(a) for a in arrays)], "<u8").tobytes() + b"".join(a.dtype.str.encode().ljust(4) for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + words + b"".join(a.tobytes() for a in arrays))


def unpack(data: bytes, n: int) -> tuple[list[bytes], list[np.ndarray]]:
    data = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(data, "<u8", n + 1).tolist()
    kinds = [np.dtype(data[8 * (n + 1) + 4 * i :][:4].decode().strip()) for i in range(n)]
    at = 8 * (n + 1) + 4 * n
    words, at = data[at : at + sizes[0]], at + sizes[0]
    out = []
    for size, kind in zip(sizes[1:], kinds):
        out.append(np.frombuffer(data, kind, size, at))
        at += size * kind.itemsize
    return words.split(b" "), out


def stripes(own: np.ndarray, is_start: np.ndarray, known: int, longest: int):
    """(numbers by place, counts) of the stripes of prefixes of 1, 2, ... words: the prefix, then the next word (0: none, for
    prefixes of one word)."""
    padded = np.append(own, np.zeros(longest - 1, np.uint32))
    n = len(own)
    at = is_start & (own > 0)
    for k in range(2, longest + 1):
        goes_on = at & (padded[k - 1 : n + k - 1] > 0)
        yield summed([padded[j : n + j][at if k == 2 else goes_on] for j in range(k)], None, known)
        at = goes_on


def cells_of(ids: list[np.ndarray], hashes: np.ndarray, lang: int, n: int) -> np.ndarray:
    """The cell of each stripe entry: by the language, the prefix and the part that the next word is in."""
    h = np.full(len(ids[0]), lang, np.uint64)
    for x in ids[:-1]:
        h = mixed(h, hashes[x])
    h = mixed(h, hashes[ids[-1]] % np.uint64(SPLIT))
    return (h % np.uint64(n)).astype(np.int64)


def counted(df: DataFrame, cells: int, longest: int, block: int = BLOCK) -> DataFrame:
    """cell int, lang string, block binary: the stripes of all texts. df: lang, text."""
    schema = pa.schema([("cell", pa.int32()), ("lang", pa.string()), ("block", pa.binary())])

    def run(batches: common.Batches) -> common.Batches:
        numbers, held, size = Numbers(), {}, 0

        def flushed() -> common.Batches:
            nonlocal numbers, held, size
            names = np.array(list(numbers), object)
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
            numbers, parts, size = Numbers(), held, 0
            held = {}
            for lang, found in parts.items():
                own, starts = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
                sent = []
                for ids, counts in stripes(own, starts, len(names), longest):
                    where = cells_of(ids, hashes, xxhash.xxh64_intdigest(lang.encode()), cells)
                    order = np.argsort(where.astype(np.min_scalar_type(cells)), kind="stable")
                    cut = np.searchsorted(where[order], np.arange(cells + 1))
                    sent.append(([x[order] for x in ids], counts[order], cut))
                for c in range(cells):
                    pieces = [([x[cut[c] : cut[c + 1]] for x in ids], counts[cut[c] : cut[c + 1]]) for ids, counts, cut in sent]
                    if not any(len(p[1]) for p in pieces):
                        continue
                    used = np.unique(np.concatenate([x for ids, _ in pieces for x in ids] + [np.zeros(1, np.uint32)]))
                    arrays = []
                    for ids, counts in pieces:
                        arrays += [*(narrow(np.searchsorted(used, x)) for x in ids), narrow(counts)]
                    yield common.batch_of(schema, [[c], [lang], [pack(b" ".join(names[used[1:]].tolist()), arrays)]])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), common.utf8(batch, "text")):
                words = tokens(text)
                for at in range(0, len(words), block):  # a very long text in parts, each sees the first words of the next
                    part = words[at : at + block + longest - 1]
                    if size and size + len(part) + 1 > block + longest:
                        yield from flushed()
                    ids = np.append(numbers.of(part), np.uint32(0))  # a break after each
                    starts = np.zeros(len(ids), bool)
                    starts[: min(block, len(words) - at)] = True
                    held.setdefault(lang, []).append((ids, starts))
                    size += len(ids)
        if held:
            yield from flushed()

    return df.select("lang", "text").mapInArrow(run, "cell int, lang string, block binary")


def merged(blocks: DataFrame, longest: int, least: int) -> DataFrame:
    """lang, length, phrase, a: phrases of 2 words or more with `least` occurrences, and, for each part of its stripe, a share
    of each single word's occurrences. Blocks of a cell are merged elementwise."""
    schema = pa.schema([("lang", pa.string()), ("length", pa.int32()), ("phrase", pa.binary()), ("a", pa.int64())])
    arrays = sum(k + 1 for k in range(2, longest + 1))

    def finish(lang: str, rows: list[bytes]) -> common.Batches:
        numbers, by_length = Numbers(), [[] for _ in range(2, longest + 1)]
        for data in rows:
            words, found = unpack(data, arrays)
            back = np.append(np.zeros(1, np.uint32), numbers.of(words))
            at = 0
            for k, place in zip(range(2, longest + 1), by_length):
                place.append(([back[x] for x in found[at : at + k]], found[at + k].astype(np.uint64)))
                at += k + 1
        names = np.array(list(numbers), object)
        for k, place in zip(range(2, longest + 1), by_length):
            ids, a = summed([np.concatenate([p[0][j] for p in place]) for j in range(k)], np.concatenate([p[1] for p in place]), len(names))
            place.clear()
            if k == 2 and len(a):
                new = np.flatnonzero(np.append(True, ids[0][1:] != ids[0][:-1]))
                yield from sent(lang, 1, [names[ids[0][new]]], np.add.reduceat(a, new))
            keep = (a >= least) & (ids[-1] > 0)
            yield from sent(lang, k, [names[x[keep]] for x in ids], a[keep])

    def sent(lang: str, length: int, words: list[np.ndarray], a: np.ndarray) -> common.Batches:
        for at in range(0, len(a), 50_000):
            part = [b" ".join(p) for p in zip(*(w[at : at + 50_000].tolist() for w in words))]
            yield common.batch_of(schema, [[lang] * len(part), [length] * len(part), part, a[at : at + 50_000].astype(np.int64)])

    def run(batches: common.Batches) -> common.Batches:
        now, rows = None, []
        for batch in batches:
            for cell, lang, block in zip(*(c.to_pylist() for c in batch.columns)):
                if (cell, lang) != now and rows:
                    yield from finish(now[1], rows)
                    rows = []
                now = (cell, lang)
                rows.append(block)
        if rows:
            yield from finish(now[1], rows)

    dealt = blocks.repartition("cell").sortWithinPartitions("cell", "lang")
    found = dealt.mapInArrow(run, "lang string, length int, phrase binary, a long")
    return found.withColumn("phrase", F.col("phrase").cast("string"))


def looked_up(df: DataFrame, grams: DataFrame, hot: DataFrame, part: str, name: str) -> DataFrame:
    """df with the count of the phrase in column `part`: hot ones by broadcast, and spread, so that the join has no hot key."""
    small = hot.select(F.col("lang"), F.col("phrase").alias(part), F.col("a").alias("_hot"))
    large = grams.select("lang", F.col("phrase").alias(part), F.col("a").alias("_cold"), F.lit(0).cast("long").alias("_deal"))
    spread = F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(F.xxhash64("phrase").bitwiseOR(F.lit(1)))
    met = df.join(F.broadcast(small), ["lang", part], "left").withColumn("_deal", spread).join(large, ["lang", part, "_deal"], "left")
    return met.withColumn(name, F.coalesce("_hot", "_cold")).drop("_hot", "_cold", "_deal")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact in 38 digits for counts of up to 16 digits."""
    a, left, right = (c.cast("decimal(16,0)") for c in (a, left, right))
    return F.call_function("div", (a * a).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)"), left * right)


def part_of(phrase: Column, words: Column) -> Column:
    """The first words of a phrase, or the last for a negative number."""
    return F.call_function("substring_index", phrase, F.lit(" "), words)


def phrases(
    df: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10, share: int = 50, top: int = 2000, cells: int | None = None, block: int = BLOCK
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of 2 to `longest` words of each language.

    A candidate has `least` occurrences; it is dropped when a longer candidate that holds it has `share` per cent of its
    occurrences (looking at phrases one word longer is enough, as each longer one lies in such a phrase that has at least
    as many). cells: how many merge the stripes; by default as many as shuffle partitions, or more for much text.
    Null and empty texts have no words, null languages are `und`; rows count as often as they occur; texts of any length
    are read in whole; an empty table gives an empty result. Other columns of df are not read.
    """
    spark = df.sparkSession
    rows = df.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    if cells is None:
        size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
        cells = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // CELL_BYTES))
    found = common.stored(merged(counted(rows, cells, longest, block), longest, least), "stripes")
    words = found.where("length = 1").groupBy("lang", "phrase").agg(F.sum("a").alias("a")).select("lang", F.lit(1).alias("length"), "phrase", "a")
    grams = common.stored(words.unionByName(found.where("length > 1")), "phrases")
    totals = grams.where("length = 1").groupBy("lang").agg(F.sum("a").alias("n"))
    everything = grams.where("length = 1").agg(F.coalesce(F.sum("a"), F.lit(0)).alias("n")).first()["n"]
    candidates = grams.where("length > 1")

    longer = candidates.where("length > 2").select(
        "lang", "a", F.explode(F.array(part_of(F.col("phrase"), F.col("length") - 1), part_of(F.col("phrase"), 1 - F.col("length")))).alias("phrase")
    )
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    cuts = kept.select("lang", "phrase", "length", "a", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k")).select(
        "*", part_of(F.col("phrase"), F.col("k")).alias("left"), part_of(F.col("phrase"), F.col("k") - F.col("length")).alias("right")
    )
    common_ones = grams.where(F.col("a") * HOT >= max(everything, 1))  # at most HOT for each length
    known = grams.where((F.col("a") >= least) & (F.col("length") < longest))
    for part, name in (("left", "l"), ("right", "r")):
        cuts = looked_up(cuts, known, common_ones, part, name)
    cuts = cuts.withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")).select("lang", "phrase", "cut.*")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    first = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
