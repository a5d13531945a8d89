"""Interpolated modified Kneser-Ney language model of any order, counted in Spark and kept as sorted hash arrays.

Counting. Every task turns words into 64-bit hashes, sums equal n-grams of some million tokens at a time, and sends them as
packed blocks (their words once, then numbers; words that are frequent in a bounded sample of the texts by their rank there,
the others by their hashes) to a grid of cells: rows of the grid by the last word's hash, columns by the hash of the word before it. A
frequent word is thereby spread over a row and a column of cells, never in one task. All n-grams that end in the same two
words are in one cell, so a cell also has the lower orders down to pairs: a lower n-gram counts the distinct words that
stand before it. A cell sums its n-grams, writes one sorted hash array per order to the shared folder, and sends what it
knows of contexts (totals and counts of counts) on: of single words, with occurrences and distinct contexts, to the shard
that owns the word's hash range, and of longer contexts to the cell of their last two words, which keep them beside the
n-grams of the same words. Only a few totals per file come to the driver.

Scoring. Workers memory-map the files once; a block of texts looks its distinct words and n-grams up in sorted order.

p(w | h) = max(c(h, w) - D(c(h, w)), 0) / c(h) + gamma(h) * p(w | h less its first word), where c are occurrences in the
highest order and numbers of distinct words before in the lower ones; a context that wasn't met passes to the next order. A
text begins with order - 1 start marks. The words' own p is interpolated with 1 / (V + 1): V words (the end among them) and
one place for all unknown words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, hash_arrays

MARKS = {b"\n": 0, b"\n\n": 1}  # the end and the start mark: white space can't be in a word
END, START = map(xxhash.xxh64_intdigest, MARKS)
FIRST = np.uint64(0x9E3779B97F4A7C15)  # any odd numbers
SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
KEY = 56  # bits of an n-gram's hash; a cell of a million n-grams has two equal ones with a chance of 1 in 100,000
COUNTED = 3_500_000
CELL_BYTES = 24 << 20  # text a cell of the grid stands for
FACT_BYTES = 8 << 20  # of packed facts that a task writes or reads at once
SAMPLED = 24 << 20  # text that the frequent words are taken from
FREQUENT = 1 << 19  # words that blocks name by rank; more or fewer change no result
SCORED = 400_000
CACHED = 1_000_000
FACTS = ("count", "contexts", "total", "ones", "twos", "more")


class Numbers(dict):
    """Word -> its number in order of first sight, for one block of texts."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n

    def of(self, text: bytes) -> np.ndarray:
        """Numbers of a text's tokens: lower-cased words (A-Z), then the end, which is number 0."""
        words = text.lower().split()
        out = np.zeros(len(words) + 1, np.uint32)
        out[:-1] = np.fromiter(map(self.__getitem__, words), np.uint32, len(words))
        return out


class Hashes(dict):
    """Word -> hash; forgets all when it holds CACHED words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, text: bytes) -> np.ndarray:
        """Hashes of a text's tokens: lower-cased words (A-Z), then the end."""
        words = text.lower().split()
        out = np.empty(len(words) + 1, np.uint64)
        out[:-1] = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        out[-1] = END
        return out


def columns(held: list[np.ndarray], order: int, mark: int = START) -> list[np.ndarray]:
    """The n-grams of texts, one array per place; texts begin with order - 1 start marks."""
    start = np.full(order - 1, mark, held[0].dtype)
    padded = [np.concatenate((start, h)) for h in held]
    return [np.concatenate([p[k : len(p) - order + 1 + k] for p in padded]) for k in range(order)]


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (first * FIRST) ^ (second >> np.uint64(29)) ^ (second * SECOND)
    return (mixed ^ (mixed >> np.uint64(32))) * FIRST


def gram_key(words: list[np.ndarray]) -> np.ndarray:
    """The hash of n-grams in KEY bits."""
    key = words[0]
    for w in words[1:]:
        key = pair_key(key, w)
    return key >> np.uint64(64 - KEY)


def slot(hashes: np.ndarray, side: int, high: bool) -> np.ndarray:
    """Which of `side` equal ranges of the upper (or, for the grid's columns, the lower) 32 bits a hash is in."""
    part = hashes >> np.uint64(32) if high else hashes & np.uint64(0xFFFFFFFF)
    return ((part * np.uint64(side)) >> np.uint64(32)).astype(np.int64)


def cell_of(first: np.ndarray, second: np.ndarray, side: int) -> np.ndarray:
    return slot(second, side, True) * side + slot(first, side, False)


def planes(a: np.ndarray) -> bytes:
    """The bytes of an array, all first bytes first: equal upper bytes then cost nothing."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def pack(arrays: list[np.ndarray], rising: tuple[int, ...] = ()) -> bytes:
    """Arrays as one compressed block; those at the places `rising` are in ascending order and kept as differences."""
    arrays = [np.diff(a, prepend=a.dtype.type(0)) if i in rising else a for i, a in enumerate(arrays)]
    head = np.array([len(a) for a in arrays], "<u8").tobytes() + b"".join(a.dtype.str.encode().ljust(4) for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(map(planes, arrays)))


def unpack(data: bytes, n: int, rising: tuple[int, ...] = ()) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    at, out = 12 * n, []
    for i in range(n):
        size, kind = int.from_bytes(data[8 * i : 8 * i + 8], "little"), np.dtype(data[8 * n + 4 * i : 8 * n + 4 * i + 4].decode().strip())
        raw = np.frombuffer(data, np.uint8, size * kind.itemsize, at)
        a = np.ascontiguousarray(raw.reshape(kind.itemsize, size).T).view(kind).reshape(size) if kind.itemsize > 1 else raw.view(kind)
        out.append(np.cumsum(a, dtype=kind) if i in rising else a)
        at += size * kind.itemsize
    return out


def in_order(ids: list[np.ndarray], known: int) -> np.ndarray:
    """The order of n-grams of word numbers below `known`, by the last word, then the one before, and so on."""
    bits = max(1, known.bit_length())
    if bits * len(ids) > 64:
        return np.lexsort(ids)
    key = np.zeros(len(ids[0]), np.uint64)
    for x in reversed(ids):
        key = (key << np.uint64(bits)) | x.astype(np.uint64)
    return np.argsort(key)


def starts_of(ids: list[np.ndarray]) -> np.ndarray:
    """Where runs of equal n-grams begin in sorted ones."""
    new = np.zeros(len(ids[0]), bool)
    new[:1] = True
    for x in ids:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def summed(ids: list[np.ndarray], counts: np.ndarray | None, known: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct n-grams of word numbers, in order, with summed counts (None: ones)."""
    order = in_order(ids, known)
    ids = [x[order] for x in ids]
    new = starts_of(ids)
    if counts is None:
        return [x[new] for x in ids], np.diff(np.append(new, len(order))).astype(np.uint32)
    return [x[new] for x in ids], np.add.reduceat(counts[order], new) if len(new) else counts


def frequent_words(df: DataFrame, folder: str, size: int) -> None:
    """Write the hashes of the most frequent words in a sample of the texts (`size` bytes in all): in order of the hashes with
    their ranks, and by rank. It only makes blocks shorter."""
    schema = pa.schema([("hash", pa.int64()), ("n", pa.int64())])

    def run(batches: common.Batches) -> common.Batches:
        numbers, held = Numbers(MARKS), []
        for batch in batches:
            held += [numbers.of(text) for text in common.utf8(batch, "text")]
        if held:
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
            yield common.batch_of(schema, [hashes.view(np.int64), np.bincount(np.concatenate(held), minlength=len(numbers))])

    found = df.sample(min(1.0, SAMPLED / max(size, 1)), 1).mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    top = common.stored(found.orderBy(F.desc("n"), "hash").limit(FREQUENT), "kneser-ney-frequent").toArrow()
    top, n = (top.column(name).to_numpy() for name in ("hash", "n"))
    top = top[np.lexsort((top, -n))].view(np.uint64)
    by_hash = np.argsort(top)
    hash_arrays.write(f"{folder}/frequent.bin", {"key": top[by_hash], "rank": by_hash.astype(np.uint32), "hash": top})


def blocks(held: list[np.ndarray], words: list[bytes], frequent: hash_arrays.File, side: int, order: int):
    """(cell, packed block) of the n-grams of texts (word numbers): the words of the block (ranks of the frequent ones, then
    hashes of the others), for each place their numbers, then the counts. words: by number; the first two are the end and the
    start mark."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    by = np.argsort(hashes)
    at, there = hash_arrays.find(frequent, hashes[by])
    ranks = frequent["rank"][at[there]]
    by_rank = np.argsort(ranks)
    ranks, by = ranks[by_rank], np.concatenate((by[there][by_rank], by[~there]))
    rank = np.empty(len(words), np.uint32)
    rank[by] = np.arange(len(words), dtype=np.uint32)
    ids, counts = summed([rank[x] for x in columns(held, order, 1)], None, len(words))
    hashes, n = hashes[by], len(ranks)
    cells = cell_of(hashes[ids[-2]], hashes[ids[-1]], side)
    by = np.argsort(cells.astype(np.min_scalar_type(side * side)), kind="stable")
    ids, counts, cells = [x[by] for x in ids], counts[by], cells[by]
    cut = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1], [True])))
    for a, b in zip(cut[:-1], cut[1:]):
        there = np.zeros(len(words), bool)
        for x in ids:
            there[x[a:b]] = True
        number = np.cumsum(there) - 1
        own = [hash_arrays.narrow(number[x[a:b]]) for x in ids]
        yield int(cells[a]), pack([ranks[there[:n]], hashes[n:][there[n:]], *own, hash_arrays.narrow(counts[a:b])], (0, 1, order + 1))


def counted(df: DataFrame, folder: str, side: int, order: int) -> DataFrame:
    """cell int, block binary: the n-grams of all texts, summed some million tokens at a time."""
    schema = pa.schema([("cell", pa.int32()), ("block", pa.binary())])

    def run(batches: common.Batches) -> common.Batches:
        numbers, held, size = Numbers(MARKS), [], 0
        frequent = hash_arrays.mapped(f"{folder}/frequent.bin")

        def flushed() -> common.Batches:
            nonlocal numbers, held, size
            words, texts = list(numbers), held
            numbers, held, size = Numbers(MARKS), [], 0
            for cell, block in blocks(texts, words, frequent, side, order):
                yield common.batch_of(schema, [[cell], [block]])

        for batch in batches:
            for text in common.utf8(batch, "text"):
                held.append(numbers.of(text))
                size += len(held[-1])
                if size >= COUNTED:
                    yield from flushed()
        if held:
            yield from flushed()

    return df.mapInArrow(run, "cell int, block binary")


def by_group(batches: common.Batches):
    """(group number, list of the other columns' rows) for batches that are sorted by their first column."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != now and rows:
                yield now, rows
                rows = []
            now = row[0]
            rows.append(row[1:])
    if rows:
        yield now, rows


def count_of_counts(values: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(values, 5), minlength=6)[1:5].tolist()


def cells(grams: DataFrame, folder: str, side: int, order: int) -> DataFrame:
    """Write the n-gram arrays of all orders; shard int, block binary: facts of words (shards below side), of contexts of
    k - 1 words (the shards of order k follow), and, with shard -k, the file's counts of counts of order k."""
    schema = pa.schema([("shard", pa.int32()), ("block", pa.binary())])

    def run(batches: common.Batches) -> common.Batches:
        by_rank = hash_arrays.mapped(f"{folder}/frequent.bin")["hash"]
        for cell, rows in by_group(batches):
            parts = [unpack(block, order + 3, (0, 1, order + 1)) for (block,) in rows]
            parts = [[np.concatenate((by_rank[ranks], hashes)), *p] for ranks, hashes, *p in parts]
            known = np.unique(np.concatenate([p[0] for p in parts]))
            back = [np.searchsorted(known, p[0]).astype(np.uint32) for p in parts]
            ids = [np.concatenate([n[p[k + 1]] for n, p in zip(back, parts)]) for k in range(order)]
            del back
            ids, count = summed(ids, np.concatenate([p[-1].astype(np.uint64) for p in parts]), len(known))
            del parts, rows
            occurred = known[ids[-1]], count
            for k in range(order, 1, -1):
                own = [known[x] for x in ids]
                key = gram_key(own)
                by_key = np.argsort(key)
                hash_arrays.write(f"{folder}/grams{k}-{cell:06d}.bin", hash_arrays.keys(key[by_key], KEY) | hash_arrays.values("count", count[by_key]))
                yield common.batch_of(schema, [[-k], [np.array(count_of_counts(count), "<i8").tobytes()]])
                if k > 2:
                    for shard, block in sent(cell_of(own[-3], own[-2], side) + side + (k - 3) * side * side, gram_key(own[:-1]), count):
                        yield common.batch_of(schema, [[shard], [block]])
                    new = starts_of(ids[1:])
                    count = np.diff(np.append(new, len(count))).astype(np.uint64)  # distinct words before
                    ids = [x[new] for x in ids[1:]]
            facts = word_facts(*own, count, *occurred)
            shards = slot(facts[0], side, True)
            cut = np.flatnonzero(np.concatenate(([True], shards[1:] != shards[:-1], [True])))
            for a, b in zip(cut[:-1], cut[1:]):
                yield common.batch_of(schema, [[int(shards[a])], [pack([facts[0][a:b], *(hash_arrays.narrow(f[a:b]) for f in facts[1:])], (0,))]])

    return grams.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "shard int, block binary")


def sent(shards: np.ndarray, key: np.ndarray, count: np.ndarray):
    """(shard, packed facts) of contexts: total, ones, twos and more by context key."""
    order = np.lexsort((key, shards))
    shards, key, count = shards[order], key[order], count[order]
    new = starts_of([shards, key])
    columns = [np.add.reduceat(x, new) for x in (count, *((f * np.uint64(1)) for f in (count == 1, count == 2, count > 2)))]
    shards, key = shards[new], key[new]
    cut = np.flatnonzero(np.concatenate(([True], shards[1:] != shards[:-1], [True])))
    for a, b in zip(cut[:-1], cut[1:]):
        yield int(shards[a]), pack([key[a:b], *(hash_arrays.narrow(c[a:b]) for c in columns)], (0,))


def word_facts(first: np.ndarray, second: np.ndarray, count: np.ndarray, word: np.ndarray, occurred: np.ndarray) -> list[np.ndarray]:
    """Sorted word hashes and, for each, FACTS: as a last word occurrences and contexts; as the word before it the rest."""
    places = (word, second, first)
    ones = np.ones(len(first), np.uint64)
    values = [(occurred, None, None), (None, ones, None), *((None, None, f * np.uint64(1)) for f in (count, count == 1, count == 2, count > 2))]
    return merged(np.concatenate(places), [np.concatenate([np.zeros(len(p), np.uint64) if v is None else v for p, v in zip(places, own)]) for own in values])


def merged(words: np.ndarray, columns: list[np.ndarray]) -> list[np.ndarray]:
    order = np.argsort(words)
    words = words[order]
    new = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1])))
    return [words[new], *(np.add.reduceat(c[order], new) for c in columns)]


def contexts(folder: str, order: int, cell: int, found: list[np.ndarray]) -> None:
    """Write the facts of a cell's contexts of order - 1 words beside the n-grams of these words, whose keys they share.

    A context that is no such n-gram (start marks alone) goes to a short list of its own.
    """
    key, facts = found[0], found[1:]
    try:
        grams = hash_arrays.mapped(f"{folder}/grams{order - 1}-{cell:06d}.bin")
        at, there = hash_arrays.find(grams, key)
        n = len(grams["key"] if "key" in grams else grams["low"])
    except FileNotFoundError:
        at, there, n = np.zeros(len(key), np.int64), np.zeros(len(key), bool), 0
    held, beside = {"other": key[~there]}, []
    for name, f in zip(FACTS[2:], facts):
        beside.append(np.zeros(n, np.uint64))
        beside[-1][at[there]] = f[there]
        held[f"other.{name}"] = f[~there]
    held |= hash_arrays.coded("facts", beside)
    hash_arrays.write(f"{folder}/contexts{order}-{cell:06d}.bin", held)


def words(facts: DataFrame, folder: str, side: int) -> DataFrame:
    """Write the word and context arrays; stats binary: per word file eight totals of words, per order (shard -k) four counts
    of counts."""
    schema = pa.schema([("shard", pa.int32()), ("stats", pa.binary())])

    def run(batches: common.Batches) -> common.Batches:
        for shard, rows in by_group(batches):
            if shard < 0:
                total = np.sum([np.frombuffer(r[0], "<i8") for r in rows], axis=0)
                yield common.batch_of(schema, [[shard], [total.astype("<i8").tobytes()]])
                continue
            if shard >= side:
                parts = [unpack(r[0], 5, (0,)) for r in rows]
                found = merged(np.concatenate([p[0] for p in parts]), [np.concatenate([p[i] for p in parts]).astype(np.uint64) for i in range(1, 5)])
                k, cell = divmod(shard - side, side * side)
                contexts(folder, k + 3, cell, found)
                continue
            parts = [unpack(r[0], 7, (0,)) for r in rows]
            found = merged(np.concatenate([p[0] for p in parts]), [np.concatenate([p[i] for p in parts]).astype(np.uint64) for i in range(1, 7)])
            held = {}
            for name, f in zip(FACTS, found[1:]):
                held |= hash_arrays.values(name, f)
            hash_arrays.write(f"{folder}/words-{shard:06d}.bin", hash_arrays.keys(found[0]) | held)
            stats = [int((found[1] > 0).sum()), int(found[1].sum()), int(found[2].sum()), *count_of_counts(found[2])]
            high = found[2][found[2] > 2]
            yield common.batch_of(schema, [[shard], [np.array([*stats, len(high)], "<i8").tobytes()]])

    return facts.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "shard int, stats binary")


def discounts(n: list[int]) -> tuple[float, float, float]:
    """The three discounts from counts of counts; kept inside (0, count) where data are too few for the estimate."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    found = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k / 2 for k in (1, 2, 3)]
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), found))


@dataclass(frozen=True)
class Model:
    """Where the arrays are and the few totals that complete them."""

    folder: str
    side: int
    tokens: int
    vocabulary: int
    pairs: int  # distinct pairs
    order: int
    discounts: dict[int, tuple[float, float, float]]  # by order, from 2 on
    low_discount: tuple[float, float, float]
    low_gamma: float

    def open(self) -> Scorer:
        return Scorer(self)


def train(df: DataFrame, text: str = "text", folder: str | None = None, side: int | None = None, order: int = 2) -> Model:
    """Count the texts of df (null: empty) and write the model of n-grams of `order` words (2 or more) to the shared folder.

    side: the grid has side x side cells; by default as many as there are shuffle partitions, or more for much text.
    """
    if order < 2:
        raise ValueError("the order is 2 or more")
    spark = df.sparkSession
    folder = folder or common.shared_path(spark, "kneser-ney")
    texts = df.select(F.col(text).alias("text"))
    with common.freed_shuffles(spark):  # the n-grams' blocks leave the disk before the facts are dealt
        size = texts.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0)).alias("n")).first()["n"]
        if side is None:
            wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size / CELL_BYTES)
            side = max(2, math.ceil(math.sqrt(wanted)))
        frequent_words(texts, folder, size)
        facts = common.stored(cells(counted(texts, folder, side, order), folder, side, order), "kneser-ney-facts", **{"parquet.block.size": FACT_BYTES, "compression": "none"})
        stats = words(facts, folder, side).collect()
    high = {k: discounts(np.sum([np.frombuffer(r.stats, "<i8") for r in stats if r.shard == -k] or [np.zeros(4, int)], axis=0).tolist()) for k in range(2, order + 1)}
    low = np.sum([np.frombuffer(r.stats, "<i8") for r in stats if r.shard >= 0] or [np.zeros(8, int)], axis=0).tolist()
    vocabulary, tokens, distinct, *counts, more = low
    d = discounts(counts)
    gamma = (d[0] * counts[0] + d[1] * counts[1] + d[2] * more) / distinct if distinct else 1.0
    return Model(folder, side, tokens, vocabulary, distinct, order, high, d, gamma)


class Scorer:
    """Look-ups in the memory-mapped arrays of a model, inside one worker."""

    def __init__(self, model: Model):
        self.model = model
        self.files: dict[str, dict[str, np.ndarray]] = {}
        self.high = {k: np.array([0.0, *d]) for k, d in model.discounts.items()}
        self.low = np.array([0.0, *model.low_discount])

    def file(self, kind: str, n: int) -> dict[str, np.ndarray] | None:
        name = f"{kind}-{n:06d}.bin"
        if name not in self.files:
            try:
                self.files[name] = hash_arrays.mapped(f"{self.model.folder}/{name}")
            except FileNotFoundError:  # no n-gram or word fell into it
                self.files[name] = {}
        return self.files[name] or None

    def facts(self, hashes: np.ndarray) -> np.ndarray:
        """(6, n) FACTS of sorted distinct hashes; zeros for unknown words."""
        out = np.zeros((len(FACTS), len(hashes)))
        shards = slot(hashes, self.model.side, True)
        cut = np.flatnonzero(np.concatenate(([True], shards[1:] != shards[:-1], [True])))
        for a, b in zip(cut[:-1], cut[1:]):
            if file := self.file("words", int(shards[a])):
                at, there = hash_arrays.find(file, hashes[a:b])
                for i, name in enumerate(FACTS):
                    out[i, a:b][there] = hash_arrays.take(file, name, at[there])
        return out

    def looked_up(self, k: int, grams: list[np.ndarray], contexts: bool):
        """Counts of n-grams of k words, each the last k of `grams`; with `contexts` also (4, n) facts of the k words before
        the last, which but for the beginnings of texts are the n-grams one place earlier."""
        key = gram_key(grams[-k:])
        words, n = [grams[-2], grams[-1]], len(key)
        if contexts:
            before = gram_key(grams[-k - 1 : -1])
            other = np.flatnonzero(np.append(True, before[1:] != key[:-1]))
            key = np.append(key, before[other])
            words = [np.append(w, x[other]) for w, x in zip(words, (grams[-3], grams[-2]))]
        order = np.argsort(key)
        key = key[order]
        new = np.append(True, key[1:] != key[:-1])
        back = np.empty(len(key), np.int64)
        back[order] = np.cumsum(new) - 1
        key, at = key[new], order[new]
        cells = cell_of(words[0][at], words[1][at], self.model.side)
        order = np.argsort(cells.astype(np.min_scalar_type(self.model.side**2)), kind="stable")
        cells = cells[order]
        cut = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1], [True])))
        count, facts = np.zeros(len(key)), np.zeros((4, len(key) if contexts else 0))
        for a, b in zip(cut[:-1], cut[1:]):
            own, cell = order[a:b], int(cells[a])
            file = self.file(f"grams{k}", cell) or {"key": np.zeros(0, np.uint64)}
            place, there = hash_arrays.find(file, key[own])
            place, known = place[there], own[there]
            if len(known):
                count[known] = hash_arrays.take(file, "count", place)
            if contexts and (beside := self.file(f"contexts{k + 1}", cell)):
                if len(known):
                    facts[:, known] = hash_arrays.decoded(beside, "facts", place, 4)
                other_at, also = hash_arrays.find({"key": beside["other"]}, key[own])
                for i, name in enumerate(FACTS[2:]):
                    facts[i, own[also]] = beside[f"other.{name}"][other_at[also]]
        if not contexts:
            return count[back], None
        where = np.empty(n, np.int64)
        where[1:] = back[: n - 1]
        where[other] = back[n:]
        return count[back[:n]], facts[:, where]

    def score(self, grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each n-gram's last word: known, log10 of the add-one base, log10 of the model's probability."""
        m, tokens, first = self.model, grams[-1], grams[-2]
        hashes, back = np.unique(np.concatenate((tokens, first)), return_inverse=True)
        found = self.facts(hashes)
        word, context = back[: len(tokens)], back[len(tokens) :]
        count, contexts = found[0][word], found[1]
        base = np.log10((count + 1) / (m.tokens + m.vocabulary + 1))
        low = np.maximum(contexts - self.low[np.minimum(contexts, 3).astype(int)], 0) / max(m.pairs, 1) + m.low_gamma / (m.vocabulary + 1)
        p, facts = low[word], found[2:, context]
        for k in range(2, m.order + 1):
            total, *more = facts
            seen = np.maximum(total, 1)
            spread = (self.high[k][1:, None] * np.array(more)).sum(axis=0)
            own, facts = self.looked_up(k, grams, k < m.order)
            p = np.maximum(own - self.high[k][np.minimum(own, 3).astype(int)], 0) / seen + np.where(total > 0, spread / seen, 1) * p
        return count > 0, base, np.log10(p)


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, n_known, base_score, score of each row (null text: the end token alone)."""
    schema = pa.schema([("key", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: common.Batches) -> common.Batches:
        hashes, scorer = common.held_by_worker(("scorer", model.folder), lambda: (Hashes(), model.open()))

        def scored(keys: list, held: list[np.ndarray]) -> pa.RecordBatch:
            sizes = np.array([len(h) for h in held])
            starts = np.cumsum(sizes) - sizes
            parts: list[list[np.ndarray]] = [[], [], []]
            grams = columns(held, model.order)
            for at in range(0, len(grams[0]), 4 * SCORED):  # a single very long text in parts
                for part, x in zip(parts, scorer.score([g[at : at + 4 * SCORED] for g in grams])):
                    part.append(x)
            known, base, own = (np.add.reduceat(np.concatenate(p).astype(float), starts) for p in parts)
            return common.batch_of(schema, [keys, sizes, known.astype(np.int64), base, own])

        for batch in batches:
            keys, held, size = [], [], 0
            for k, t in zip(batch.column(0).to_pylist(), common.utf8(batch, "text")):
                keys.append(k)
                held.append(hashes.of(t))
                size += len(held[-1])
                if size >= SCORED:
                    yield scored(keys, held)
                    keys, held, size = [], [], 0
            if held:
                yield scored(keys, held)

    return df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(run, "key long, n_tokens long, n_known long, base_score double, score double")


def perplexity() -> Column:
    return F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))


def held_out(key: str = "doc_id", folds: int = 7, fold: int = 2) -> Column:
    """crc32 of the key as text (null: empty text) modulo `folds` is `fold`."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds == fold


def score_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 7, fold: int = 2, order: int = 2) -> DataFrame:
    """Train on the rows that aren't held out and score every row.

    key, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity. Null and empty texts are the end token
    alone; repeated rows count and are scored as often as they occur; an empty table gives an empty result; without training
    rows every token is unknown and has probability 1. Only the key and text columns are read.
    """
    model = train(df.where(~held_out(key, folds, fold)), text, order=order)
    return score(df, model, key, text).select(
        "key", held_out("key", folds, fold).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", perplexity().alias("perplexity"),
    )
