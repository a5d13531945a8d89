"""SimHash near-duplicate detection with bit-sliced comparison.

Every text gets a 64-bit fingerprint over the XXH64 values of its word shingles. Distinct fingerprints are dealt into
buckets: the 64 bits are cut into `radius + 2` bands, and two fingerprints within `radius` bits agree on at least two
of them, so a bucket per pair of bands misses no link. Inside a bucket fingerprints are compared vertically: bit plane b
holds bit b of every row, packed 64 rows to a word, so one word operation updates 64 distances. Carry-save counters hold
the distances, and words whose 64 rows all passed the radius leave the comparison early. Links become components.

Skew: copies meet as one fingerprint (an aggregate with map-side combine), a bucket of more than `chunk` fingerprints is
cut into chunks, and each pair of chunks is a group of its own. Every pair of a bucket is compared, but a bucket emits
only links that join two groups not yet joined, so the links don't grow with the square of a group.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BITS = 64
CHUNK = 2048
BLOCK = 1 << 18
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: bytes, words: int, seed: int) -> np.ndarray:
    """XXH64 of every shingle (repeats included) of a lower-cased text; one of the whole sequence when it is shorter."""
    found = text.lower().split()  # bytes: A-Z only, and white space is x09-x0D and x20
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(found) - words + 1]
    parts = map(joined.__getitem__, map(slice, starts.tolist(), ends[words - 1 :].tolist()))
    return np.fromiter(map(xxhash.xxh64_intdigest, parts, itertools.repeat(seed)), np.uint64, len(starts))


def fold(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; 0 without hashes."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK]
        counts += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little") if len(hashes) else np.zeros(8, np.uint8)
    return int(bits.view("<u8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """One row per row: key, fp long (the 64 bits). A null or empty text has fingerprint zero."""
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])

    def run(batches: common.Batches) -> common.Batches:
        for batch in batches:
            fps = [fold(shingle_hashes(t, words, seed)) for t in common.utf8(batch, "text")]
            yield common.batch_of(schema, [batch.column(0), np.array(fps, np.uint64).view(np.int64)])

    return df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(run, "key long, fp long")


def bands(radius: int) -> list[tuple[int, int]]:
    """(first bit, bits) of radius + 2 bands, as even as possible."""
    n = radius + 2
    cut = [i * BITS // n for i in range(n + 1)]
    return [(a, b - a) for a, b in itertools.pairwise(cut)]


def band_keys(radius: int):
    """One long per pair of bands: the pair's number above the bits of the two bands."""
    keys = []
    for n, ((a, x), (b, y)) in enumerate(itertools.combinations(bands(radius), 2)):
        low = F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << x) - 1))
        high = F.shiftrightunsigned("fp", b).bitwiseAND(F.lit((1 << y) - 1))
        keys.append(F.shiftleft(F.lit(n).cast("long"), x + y) + F.shiftleft(low, y) + high)
    return F.array(*keys)


def planes_of(fps: np.ndarray) -> np.ndarray:
    """(64, ceil(n / 64) + 1) words: bit r of word w of plane b is bit b of row 64 w + r. The last word is a pad."""
    n = len(fps)
    room = np.zeros((math.ceil(n / BITS) + 1) * BITS, np.uint64)
    room[:n] = fps
    bits = np.unpackbits(room.astype("<u8").view(np.uint8).reshape(len(room), 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8").astype(np.uint64)


def shifted(plane: np.ndarray, by: int) -> np.ndarray:
    """Row r of the result is row r + by."""
    words, bits = divmod(by, BITS)
    moved = plane[words:]
    if bits:
        nxt = np.append(moved[1:], np.uint64(0))
        moved = (moved >> np.uint64(bits)) | (nxt << np.uint64(BITS - bits))
    return moved


def within(planes: np.ndarray, by: int, wanted: np.ndarray, radius: int) -> np.ndarray:
    """Of the wanted rows (packed mask), those whose distance to the row `by` later is at most radius (packed mask).

    Counters are carry-save: digit d of all rows is one word array, and adding a plane ripples through the few digits.
    A count past the digits' range sticks in `over`. After every eighth plane, words all of whose wanted rows are past
    the radius leave.
    """
    digits = max(1, radius.bit_length())
    size = len(wanted)
    out = np.zeros(size, np.uint64)
    alive = np.flatnonzero(wanted)
    counter = [np.zeros(len(alive), np.uint64) for _ in range(digits)]
    over = ~wanted[alive]
    for b in range(BITS):
        if not len(alive):
            return out
        later = shifted(planes[b], by)
        carry = planes[b][alive] ^ np.append(later, np.zeros(max(0, size - len(later)), np.uint64))[alive]
        for d in range(digits):
            counter[d], carry = counter[d] ^ carry, counter[d] & carry
        over |= carry
        if b % 8 == 7:
            past = over | past_radius(counter, radius)
            keep = np.flatnonzero(past != ONES)
            if len(keep) < len(alive):
                alive, over, counter = alive[keep], over[keep], [c[keep] for c in counter]
    out[alive] = ~(over | past_radius(counter, radius))
    return out


def past_radius(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Packed mask of rows whose counted digits are greater than radius."""
    more, same = np.zeros_like(counter[0]), np.full_like(counter[0], ONES)
    for d in reversed(range(len(counter))):
        bit = ONES if radius >> d & 1 else np.uint64(0)
        more |= same & counter[d] & ~bit
        same &= ~(counter[d] ^ bit)
    return more


def unpacked(mask: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(mask.astype("<u8").view(np.uint8), bitorder="little")[:n])


def packed(flags: np.ndarray, words: int) -> np.ndarray:
    room = np.zeros(words * BITS, bool)
    room[: len(flags)] = flags
    return np.packbits(room, bitorder="little").view("<u8").astype(np.uint64)


def bucket_links(group: np.ndarray, fps: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs that join the near rows of each group; rows of a group are adjacent.

    Row r meets row r + 1, then r + 2, and so on, for all groups at once. Where `side` is 0 both rows may be of any side;
    rows of sides 1 and 2 (two chunks of a large bucket) are compared across. A pair whose rows are joined already is
    skipped, and a group that is one set leaves.
    """
    root = np.arange(len(fps))
    rows = np.arange(len(fps))
    links: list[tuple[np.ndarray, np.ndarray]] = []
    by = 1
    while len(rows) > by:
        planes = planes_of(fps[rows])
        turn = by
        while by < len(rows) and (by < 2 * turn or len(rows) <= 4 * BITS):
            a, b = rows[:-by], rows[by:]
            near = (group[a] == group[b]) & (root[a] != root[b]) & ((side[a] == 0) | (side[a] != side[b]))
            if not (group[a] == group[b]).any():
                return joined(links)
            if near.any():
                hit = unpacked(within(planes, by, packed(near, planes.shape[1]), radius), len(near))
                one, two = join(root, a[hit], b[hit])
                links.append((one, two))
            by += 1
        # a group stays while it has rows `by` apart and isn't one set yet
        g = group[rows]
        first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        count = np.diff(np.append(first, len(rows)))
        same = np.minimum.reduceat(root[rows], first) == np.maximum.reduceat(root[rows], first)
        rows = rows[np.repeat((count > by) & ~same, count)]
    return joined(links)


def join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unite the sets of each pair in place (root stays flat); returns the pairs that were needed."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = top(int(root[x])), top(int(root[y]))
        if p != q:
            parent[max(p, q)] = min(p, q)
            kept.append((x, y))
    if kept:
        old = np.fromiter(parent, np.int64, len(parent))
        new = np.fromiter((top(x) for x in old.tolist()), np.int64, len(old))
        order = np.argsort(old)
        old, new = old[order], new[order]
        at = np.minimum(np.searchsorted(old, root), len(old) - 1)
        hit = old[at] == root
        root[hit] = new[at[hit]]
    pairs = np.array(kept, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def joined(links: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not links:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([x[0] for x in links]), np.concatenate([x[1] for x in links])


def near_links(distinct: DataFrame, radius: int = 4, chunk: int = CHUNK) -> DataFrame:
    """Links a, b (fingerprints) that join all fingerprints within radius bits. distinct: fp long (unique)."""
    rows = distinct.select("fp", F.explode(band_keys(radius)).alias("bucket"))
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    met = rows.join(counts, "bucket").withColumn("c", F.ceil(F.col("n") / chunk).cast("int"))
    mine = F.pmod(F.xxhash64("fp"), F.col("c")).cast("int")
    # chunk i meets itself (side 0) and each other chunk once (side 1 or 2)
    groups = met.withColumn("i", mine).select(
        "bucket", "fp",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.col("c") - 1),
                lambda j: F.struct(
                    F.least("i", j).alias("x"), F.greatest("i", j).alias("y"),
                    F.when(F.col("i") == j, 0).when(F.col("i") < j, 1).otherwise(2).alias("side"),
                ),
            )
        ).alias("g"),
    ).select("bucket", "g.x", "g.y", "g.side", "fp")
    dealt = groups.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y", "fp")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: common.Batches) -> common.Batches:
        rest: list[np.ndarray] | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
                rest = columns if rest is None else [np.concatenate(x) for x in zip(rest, columns)]
            if rest is None or not len(rest[0]):
                continue
            new = np.append(True, np.any([c[1:] != c[:-1] for c in rest[:3]], axis=0))
            end = len(new) if batch is None else int(np.flatnonzero(new)[-1])  # the last group may go on
            now, rest = [c[:end] for c in rest], [c[end:] for c in rest]
            if end:
                a, b = bucket_links(np.cumsum(new[:end]), now[4].view(np.uint64), now[3], radius)
                yield common.batch_of(schema, [now[4][a], now[4][b]])

    return dealt.mapInArrow(run, "a long, b long")


def near_groups(prints: DataFrame, radius: int = 4, chunk: int = CHUNK) -> DataFrame:
    """key, fp and component (the smallest key whose fingerprint is reachable) for each row of `prints` (key, fp).

    Rows with a null key keep a null key and take part in no link as a smallest key unless their whole component has none;
    then the component is null.
    """
    return prints.join(fingerprint_components(prints, radius, chunk), "fp").select("key", "fp", "component")


def fingerprint_components(prints: DataFrame, radius: int, chunk: int) -> DataFrame:
    """fp, component of each distinct fingerprint."""
    distinct = common.stored(prints.groupBy("fp").agg(F.min("key").alias("least")), "simhash-fps")
    roots = common.components(near_links(distinct, radius, chunk)).withColumnRenamed("node", "fp")
    reached = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = reached.groupBy("root").agg(F.min("least").alias("component"))
    return reached.join(least, "root").select("fp", "component")


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, seed: int = 42, radius: int = 4, chunk: int = CHUNK
) -> DataFrame:
    """key long, fingerprint string (16 hex digits), component_id long (smallest key reachable) for each row of df.

    Texts link when their fingerprints differ in `radius` bits at most. Null and empty texts have fingerprint zero and link
    like any other; repeated rows and keys give one row each; an empty table gives an empty result. Columns of df other
    than key and text are not read.
    """
    prints = common.stored(fingerprints(df, key, text, words, seed), "simhash-prints")
    found = near_groups(prints, radius, chunk)
    return found.select("key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def first_of_each(
    df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, seed: int = 42, radius: int = 4, chunk: int = CHUNK
) -> DataFrame:
    """The rows of df that are kept when each component keeps its smallest key. Rows with a null key stay.

    Rows are told apart by key and text, so different texts under one key are judged each by its own component; equal rows
    share their fate. An empty table stays empty; all columns of df are kept.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("digest"))
    schema = pa.schema([("key", pa.int64()), ("digest", pa.int64()), ("fp", pa.int64())])

    def run(batches: common.Batches) -> common.Batches:
        for batch in batches:
            fps = [fold(shingle_hashes(t, words, seed)) for t in common.utf8(batch, "text")]
            yield common.batch_of(schema, [batch.column(0), batch.column(2), np.array(fps, np.uint64).view(np.int64)])

    prints = common.stored(rows.mapInArrow(run, "key long, digest long, fp long"), "simhash-prints")
    found = prints.join(fingerprint_components(prints, radius, chunk), "fp")
    gone = found.where("key <> component").select(F.col("key").alias("_first_key"), F.col("digest").alias("_first_text")).distinct()
    same = (F.col(key).cast("long") == F.col("_first_key")) & (F.xxhash64(F.col(text)) == F.col("_first_text"))
    return df.join(gone, same, "left_anti")
