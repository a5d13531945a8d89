"""Benchmark decontamination: one Aho-Corasick automaton over the test items.

Texts are normalised to lower-case words joined by one space. A window is `words` consecutive item words; every window holds
one of the blocks that an item is cut into, each of half a window (rounded up), so the automaton's keys are these blocks (and
whole items shorter than a window), with a space at both ends: about one node a character. Each text is scanned once. Where
a block matches, the words around it are compared with the item's to both sides; a common run of a window or more is a hit,
all windows in it included. Hits are mapped back to words and to code points of the original text.

The automaton is built once per Python worker from the broadcast items. Items of more than `most_chars` characters are dealt
into several automata, which scan the texts one after the other, and the hits of a text are united.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# Word bytes: 0-9, a-z and everything beyond ASCII; A-Z are lowered, other bytes separate words.
WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
MOST_CHARS = 4_000_000  # of items in one automaton: about 0.3 GB in a worker
RUN = "struct<first: long, last: long, start: long, stop: long>"  # words, and code points of the original text
SCHEMA = f"key long, n_words long, items array<string>, runs array<{RUN}>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def key_of(words: list[bytes]) -> str:
    return " " + b" ".join(words).decode() + " "


class Scanner:
    """Scans texts for the windows of a benchmark."""

    def __init__(self, items: list[tuple[str, bytes]], words: int):
        self.words, self.block = words, (words + 1) // 2
        same: dict[bytes, bytes] = {}  # one object a word
        self.names = [name for name, _ in items]
        self.items = [[same.setdefault(w, w) for w in words_of(text)] for _, text in items]
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, own in enumerate(self.items):
            if 0 < len(own) < words:
                places[key_of(own)].append((n, 0))
            elif own:
                for at in range(0, len(own) - self.block + 1, self.block):
                    places[key_of(own[at : at + self.block])].append((n, at))
        self.places = list(places.values())
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, key in enumerate(places):
            self.machine.add_word(key, i)
        self.sizes = [len(k) for k in places]
        if self.places:
            self.machine.make_automaton()

    def run(self, own: list[bytes], at: int, item: list[bytes], place: int) -> tuple[int, int]:
        """The longest common run around word `at` of a text and word `place` of an item, as a range of the text's words."""
        left = 0
        while left < min(at, place) and own[at - left - 1] == item[place - left - 1]:
            left += 1
        right, most = 0, min(len(own) - at, len(item) - place)
        while right < most and own[at + right] == item[place + right]:
            right += 1
        return at - left, at + right

    def scan(self, text: bytes) -> tuple[int, np.ndarray, list[str]]:
        """Number of words, the sorted numbers of hit words, and the names of the items with a window in the text."""
        own = words_of(text)
        if not own or not self.places:
            return len(own), np.empty(0, np.int64), []
        normal = key_of(own)
        found = [(end - self.sizes[i] + 1, i) for end, i in self.machine.iter(normal)]
        if not found:
            return len(own), np.empty(0, np.int64), []
        spaces = np.flatnonzero(np.frombuffer(normal.encode("utf-32-le"), np.uint32) == 32)  # spaces[i] is before word i
        starts = np.searchsorted(spaces, np.array([f[0] for f in found])).tolist()
        cover, numbers, seen = np.zeros(len(own) + 1, np.int64), set(), {}
        for at, (_, i) in sorted(zip(starts, found)):
            for n, place in self.places[i]:
                item = self.items[n]
                if seen.get((n, place - at), -1) > at:  # inside a run that is known
                    continue
                first, last = self.run(own, at, item, place)
                seen[n, place - at] = last
                if last - first >= min(self.words, len(item)):
                    numbers.add(n)
                    cover[first] += 1
                    cover[last] -= 1
        return len(own), np.flatnonzero(np.cumsum(cover[:-1]) > 0), sorted({self.names[i] for i in numbers})


def runs_of(text: bytes, hit: np.ndarray) -> list[dict]:
    """Runs of hit words (first, last), and their ranges of code points in the original text."""
    flags = np.frombuffer(text.translate(WORD_BYTES), np.uint8) != 0x20
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    start, stop = edge[::2], edge[1::2]  # in bytes
    point = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))  # code points before a byte
    new = np.flatnonzero(np.append(True, np.diff(hit) > 1))
    first, last = hit[new], hit[np.append(new[1:], len(hit)) - 1]
    columns = (first, last, point[start[first]], point[stop[last]])
    return [dict(zip(("first", "last", "start", "stop"), row)) for row in zip(*(c.tolist() for c in columns))]


def united(runs: list[dict]) -> list[dict]:
    """Runs of several scans as one sorted list of runs that don't touch."""
    out: list[dict] = []
    for r in sorted(runs, key=lambda r: (r["first"], r["last"])):
        if out and r["first"] <= out[-1]["last"] + 1:
            if r["last"] > out[-1]["last"]:
                out[-1]["last"], out[-1]["stop"] = r["last"], r["stop"]
        else:
            out.append(dict(r))
    return out


def groups_of(benchmark: DataFrame, item: str = "item_id", text: str = "text", most_chars: int = MOST_CHARS) -> list[list[tuple[str, bytes]]]:
    """The items with an id as (name, UTF-8 text), dealt by a hash of the name into as many groups as their size asks for."""
    rows = benchmark.where(F.col(item).isNotNull()).select(F.col(item).cast("string").alias("name"), F.col(text).alias("t"))
    size = rows.agg(F.coalesce(F.sum(F.length("t")), F.lit(0)).alias("n")).first()["n"]
    n = max(1, -(-size // most_chars))
    dealt = [rows.where(F.pmod(F.xxhash64("name"), F.lit(n)) == g) for g in range(n)]
    return [sorted((a, (b or "").encode()) for a, b in g.collect()) for g in dealt]


def worker_scanner(token: str, items: list[tuple[str, bytes]], words: int) -> Scanner:
    """The automaton that a Python worker keeps over its tasks."""
    return common.held_by_worker(("scanner", token), lambda: Scanner(items, words))


def scan(
    df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    words: int = 13, most_chars: int = MOST_CHARS,
) -> DataFrame:
    """key, n_words, n_hit, items (names sorted as strings), spans (hit code point ranges of the original text) per row.

    A null or empty text has no words; a null item has no window; items with a null id are left out, as they can't be
    named; repeated rows give one row each; texts of any length are scanned in whole. An empty benchmark hits nothing. Only
    the named columns are read. Items of more than `most_chars` characters take several scans of the texts.
    """
    groups = groups_of(benchmark, item, item_text, most_chars)
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    if len(groups) == 1:
        found = scanned(rows, groups[0], words)
    else:
        saved = common.stored(rows.withColumn("row", F.monotonically_increasing_id()), "decontaminate")
        parts = [scanned(saved.select(F.col("row").alias("key"), "text"), g, words) for g in groups]
        hits = reduce(DataFrame.unionByName, parts).groupBy("key").agg(
            F.max("n_words").alias("n_words"), F.flatten(F.collect_list("items")).alias("items"), F.flatten(F.collect_list("runs")).alias("runs")
        )  # one row of each scan
        merge = F.udf(lambda runs: united([r.asDict() for r in runs]), f"array<{RUN}>")
        hits = hits.select(F.col("key").alias("row"), "n_words", F.array_sort(F.array_distinct("items")).alias("items"), merge("runs").alias("runs"))
        found = saved.select("row", "key").join(hits, "row").drop("row")
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    spans = F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["stop"].alias("stop")))
    return found.select("key", "n_words", n_hit.alias("n_hit"), "items", spans.alias("spans"))


def scanned(rows: DataFrame, items: list[tuple[str, bytes]], words: int) -> DataFrame:
    """key, n_words, items, runs of each row (key, text) against one automaton."""
    sent = rows.sparkSession.sparkContext.broadcast(items)
    token = uuid.uuid4().hex
    schema = pa.schema([
        ("key", pa.int64()), ("n_words", pa.int64()), ("items", pa.list_(pa.string())),
        ("runs", pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "stop")]))),
    ])

    def run(batches: common.Batches) -> common.Batches:
        scanner = worker_scanner(token, sent.value, words)
        for batch in batches:
            out: list[tuple] = []
            for t in common.utf8(batch, "text"):
                n, hit, names = scanner.scan(t)
                out.append((n, names, runs_of(t, hit) if len(hit) else []))
            yield common.batch_of(schema, [batch.column(0), *([list(x) for x in zip(*out)] or [[]] * 3)])

    return rows.mapInArrow(run, SCHEMA)


def contaminated(least_share: int = 20):
    """A text is contaminated when it has hit words and they are at least 1 / least_share of its words."""
    return (F.col("n_hit") > 0) & (F.lit(least_share) * F.col("n_hit") >= F.col("n_words"))


def report(df: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """One row per row of df: key, n_words, n_hit, n_items, items_sha256, contaminated, spans."""
    return scan(df, benchmark, **how).select(
        "key", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"), "spans",
    )


def clean(df: DataFrame, benchmark: DataFrame, text: str = "text", words: int = 13, least_share: int = 20, most_chars: int = MOST_CHARS, **columns) -> DataFrame:
    """The rows of df that are not contaminated, with all their columns.

    The verdict is taken on each row's own text, so the key may repeat or be null. With one automaton it is one narrow pass;
    with several the hits of all of them decide.
    """
    groups = groups_of(benchmark, most_chars=most_chars, **columns)
    if len(groups) > 1:
        saved = common.stored(df.withColumn("_scanned_row", F.monotonically_increasing_id()), "decontaminate")
        found = scan(saved, benchmark, "_scanned_row", text, words=words, most_chars=most_chars, **{{"text": "item_text"}.get(k, k): v for k, v in columns.items()})
        bad = found.where(contaminated(least_share)).select(F.col("key").alias("_scanned_row"))
        return saved.join(bad, "_scanned_row", "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])
    sent = df.sparkSession.sparkContext.broadcast(groups[0])
    token = uuid.uuid4().hex

    def run(batches: common.Batches) -> common.Batches:
        scanner = worker_scanner(token, sent.value, words)
        for batch in batches:
            keep = []
            for t in common.utf8(batch, text):
                n, hit, _ = scanner.scan(t)
                keep.append(not (len(hit) and least_share * len(hit) >= n))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return df.mapInArrow(run, df.schema)
