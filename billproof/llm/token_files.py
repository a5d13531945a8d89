"""Token ids in seekable files: one zstandard frame per document, a trailing seek table, a checksum per frame.

File layout (little-endian): the frames in ascending key order, each holding the ids of one document as unsigned 32-bit
integers; a skippable frame with the keys (bitmap of null keys, then one signed 64-bit integer per document); and the seek
table, a skippable frame with compressed size, plain size and checksum (low 32 bits of XXH64) of every frame, the number of
frames, one flag byte and the closing magic number, as in the seekable format of zstandard. Any zstandard reader decodes the
file; a reader of few documents reads the tail and only the wanted frames.

Documents are dealt to files by key ranges, so file n holds smaller keys than file n + 1. A file is written under a
temporary name and then renamed; a repeated task writes the same bytes.

Tokenising caches the ids of words per Python worker, which is exact for tokenizers that never cross white space.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SKIPPABLE = 0x184D2A5E  # fixed values of the seekable format
SEEKABLE = 0x8F92EAB1
KEYS = 0x184D2A5A
WITH_CHECKSUM = 0x80
CACHED = 400_000
ROWS_PER_FILE = 4096
LEVEL = 3


# Fixed value: how tokenizers of the cached kind cut normalised text; white space is dropped.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def cuts_words(settings: dict) -> bool:
    """True for a tokenizers file that composes, lowers and cuts text by CUT, with marked word ends."""
    normal = settings.get("normalizer") or {}
    steps = [x.get("type") for x in normal.get("normalizers", [normal])]
    cut = (settings.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
    return steps == ["NFC", "Replace", "Lowercase"] and cut.get("pattern") == {"Regex": CUT} and bool(settings["model"].get("end_of_word_suffix"))


class WordCache:
    """Encodes texts by a tokenizers file, with the ids of pieces cached where the file's rules allow it (`cuts_words`).

    Text is lowered and split at white space and before signs that end a word. New pieces of letters go to the model
    itself, many in a call; others go through the whole tokenizer. Texts where that might differ (combining marks, special
    tokens, rare separators, letters that lower by context) and files with other rules take the tokenizer's own way. The cache has two generations, so that a full one keeps the
    pieces in use.
    """

    SIGN = r"[!-&(-/:-@\[-^`{-~]"
    # signs between a letter or digit and white space: a piece of their own; CUT keeps an underscore and the signs behind it together
    BEHIND = re.compile(rf"({SIGN}(?<=[^\W_]{SIGN}){SIGN}*)(?=\s)")
    UNSURE = [x.encode() for x in ("<|", "\u0130", "\u03a3", "\x85", "\x1c", "\x1d", "\x1e", "\x1f")] + [b"\xcc", b"\xcd"]  # the last: U+0300 to U+037F

    def __init__(self, path: str, most: int = CACHED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        path = common.public_file(path)
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.most = most
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cuts = cuts_words(settings)
        if self.cuts:
            self.bare = Tokenizer(self.tokenizer.model)
            self.bare.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            )
            suffix = settings["model"]["end_of_word_suffix"]
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[n for piece, n in vocabulary.items() if piece.endswith(suffix)]] = True

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def pieces(self, data: bytes, text: str) -> list[str] | None:
        """Pieces that encode one by one to the ids of the text; None where that isn't sure."""
        if not self.cuts or any(x in data for x in self.UNSURE) or not is_normalized("NFC", text):
            return None
        return self.BEHIND.sub(r" \1", text.lower()).split()

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        for at in range(0, len(texts), 256):
            block = [t.decode() for t in texts[at : at + 256]]
            pieces = list(map(self.pieces, texts[at : at + 256], block))
            found = [p and list(map(self.known.get, p)) for p in pieces]
            self.learn({p for own, ids in zip(pieces, found) if own for p, x in zip(own, ids) if x is None})
            for text, own, ids in zip(block, pieces, found):
                if own is None:
                    yield self.plain(text)
                else:
                    yield b"".join([self.known[p] if x is None else x for p, x in zip(own, ids)])

    def learn(self, new: set[str]) -> None:
        """Bring new pieces into the cache."""
        if len(self.known) + len(new) > self.most:
            self.older, self.known = self.known, {}
        for p in new:
            if p in self.older:
                self.known[p] = self.older[p]
        new = [p for p in new if p not in self.known]
        direct = [p for p in new if p.isalpha()]
        if direct:
            ids = np.array(self.bare.encode_batch_fast([" ".join(direct)], add_special_tokens=False)[0].ids, "<u4")
            stops = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(stops) != len(direct):
                raise ValueError("the model doesn't mark the ends of words")
            data, start = ids.tobytes(), 0
            for p, stop in zip(direct, stops.tolist()):
                self.known[p] = data[start:stop]
                start = stop
        if len(direct) < len(new):
            for p in set(new).difference(direct):
                self.known[p] = self.plain(p)


def word_cache(path: str) -> WordCache:
    """The cache of this Python worker: Spark reuses workers, so it serves all of a worker's tasks."""
    return common.held_by_worker(("words", path), lambda: WordCache(path))


def frames(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", end: int | None = 1, level: int = LEVEL) -> DataFrame:
    """key, frame (compressed ids with the end id) and size (plain bytes), checksum of each row's text (null: empty)."""
    schema = pa.schema([("key", pa.int64()), ("frame", pa.binary()), ("size", pa.int64()), ("checksum", pa.int64())])
    last = b"" if end is None else struct.pack("<I", end)

    def run(batches: common.Batches) -> common.Batches:
        cache = word_cache(vocabulary)
        pack = zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=True)
        for batch in batches:
            packed, sizes, sums = [], [], []
            for ids in cache.encode(common.utf8(batch, "text")):
                ids += last
                packed.append(pack.compress(ids))
                sizes.append(len(ids))
                sums.append(xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF)
            yield common.batch_of(schema, [batch.column(0), packed, sizes, sums])

    return df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(run, "key long, frame binary, size long, checksum long")


def write_file(path: str, rows: Iterable[tuple[int | None, bytes, int, int]]) -> tuple[int, int]:
    """Write one file from (key, frame, plain size, checksum) in order; returns documents and plain bytes."""
    store, place = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    store.create_dir(os.path.dirname(place), recursive=True)
    table, keys, nulls, plain = bytearray(), bytearray(), bytearray(), 0
    hidden = f"{os.path.dirname(place)}/.{os.path.basename(place)}.{uuid.uuid4().hex}"
    with store.open_output_stream(hidden) as out:
        for key, frame, size, checksum in rows:
            out.write(frame)
            table += struct.pack("<III", len(frame), size, checksum)
            keys += struct.pack("<q", key or 0)
            nulls.append(key is None)
            plain += size
        n = len(nulls)
        out.write(struct.pack("<II", KEYS, 9 * n) + bytes(nulls) + bytes(keys))
        out.write(struct.pack("<II", SKIPPABLE, 12 * n + 9) + bytes(table) + struct.pack("<IBI", n, WITH_CHECKSUM, SEEKABLE))
    store.move(hidden, place)
    return n, plain


class Reader:
    """Random access to the documents of one file; only requested frames are decompressed."""

    def __init__(self, path: str):
        store, place = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
        self.file = store.open_input_file(place)
        end = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, end - 9))
        if magic != SEEKABLE or flags != WITH_CHECKSUM:
            raise ValueError(f"{path} has no seek table")
        at = end - 9 - 12 * n
        self.table = np.frombuffer(self.file.read_at(12 * n, at), "<u4").reshape(n, 3).astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.table[:, 0])))
        at -= 8 + 9 * n
        own = self.file.read_at(9 * n, at)
        values = np.frombuffer(own, "<i8", n, n)
        self.keys = [None if own[i] else int(v) for i, v in enumerate(values)]
        self.unpack = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.keys)

    def ids(self, n: int) -> np.ndarray:
        """The ids of document n; fails when they don't match the checksum."""
        size, plain, checksum = self.table[n].tolist()
        data = self.unpack.decompress(self.file.read_at(size, int(self.starts[n])), max_output_size=max(1, plain))
        if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
            raise ValueError(f"document {n} is damaged")
        return np.frombuffer(data, "<u4")


def write(df: DataFrame, folder: str, vocabulary: str, key: str = "doc_id", text: str = "text", end: int | None = 1, rows: int = ROWS_PER_FILE) -> list[tuple[str, int, int]]:
    """Tokenise df and write it to files in `folder` in ascending key order; (path, documents, tokens) per file, in order.

    Rows with a null key come first; equal keys are ordered by checksum and frame. What comes to the driver is one row per
    file, at most 65,536 of them.
    """
    bounds = common.range_bounds(df, key, rows)
    made = frames(df, vocabulary, key, text, end).withColumn("part", common.below(bounds, F.col("key")))
    dealt = made.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("part", "key", "checksum", "frame")
    schema = pa.schema([("part", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())])

    def run(batches: common.Batches) -> common.Batches:
        rows = ((p, k, f, s, c) for b in batches for k, f, s, c, p in zip(*(x.to_pylist() for x in b.columns)))
        ahead = next(rows, None)

        def of_part(part: int) -> Iterator[tuple]:
            nonlocal ahead
            while ahead is not None and ahead[0] == part:
                yield ahead[1:]
                ahead = next(rows, None)

        while ahead is not None:
            part = ahead[0]
            path = f"{folder}/part-{part:05d}.zst"
            docs, plain = write_file(path, of_part(part))
            yield common.batch_of(schema, [[part], [path], [docs], [plain // 4]])

    found = dealt.mapInArrow(run, "part int, path string, docs long, tokens long").collect()
    return [(r.path, r.docs, r.tokens) for r in sorted(found)]


def read(spark: SparkSession, files: list[tuple[str, int, int]]) -> DataFrame:
    """key, start (ids of all documents before), n_tokens, ids_crc32, read back from the files."""
    rows, start = [], 0
    for path, _, tokens in files:
        rows.append((path, start))
        start += tokens
    schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: common.Batches) -> common.Batches:
        for batch in batches:
            for path, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = Reader(path)
                out = []
                for n, k in enumerate(reader.keys):
                    ids = reader.ids(n)
                    out.append((k, at, len(ids), zlib.crc32(ids.tobytes())))
                    at += len(ids)
                yield common.batch_of(schema, [list(x) for x in zip(*out)] or [[]] * 4)

    frame = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "path string, start long, n int")
    return frame.repartitionById(max(1, len(rows)), "n").mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long")


def round_trip(df: DataFrame, vocabulary: str, folder: str | None = None, **how) -> DataFrame:
    """Write df to token files and return what the files hold, per document.

    A null or empty text is a document of the end id alone; an empty table writes no file and gives no row; repeated rows
    are documents of their own. Only the key and text columns are read.
    """
    spark = df.sparkSession
    return read(spark, write(df, folder or common.shared_path(spark, "tokens"), vocabulary, **how))


