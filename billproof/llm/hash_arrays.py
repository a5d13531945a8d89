"""Sorted hash arrays in files: unsigned keys of up to 64 bits in ascending order and value columns, memory-mapped for look-ups.

Many keys are kept as their lower bits below an index of the upper 16; nothing of a key is lost. Value columns are bytes, with a
list of the places whose value doesn't fit.
"""

from __future__ import annotations

import json
import os
import struct
import tempfile
import uuid

import numpy as np
import pyarrow.fs as pafs

INDEXED = 1 << 16  # keys from which on the index is worth its room
FULL = 255  # a byte that stands for a value in the list

File = dict[str, np.ndarray]


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def narrow(values: np.ndarray) -> np.ndarray:
    """The smallest unsigned type that holds all values."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0), copy=False)


def keys(values: np.ndarray, bits: int = 64) -> File:
    """Columns of sorted distinct keys of 56 or 64 bits."""
    if len(values) < INDEXED:
        return {"key": values}
    starts = np.searchsorted(values >> np.uint64(bits - 16), np.arange((1 << 16) + 1, dtype=np.uint64))
    return {"start": starts.astype(np.uint64), "middle": (values >> np.uint64(32)).astype(f"u{(bits - 48) // 8}"), "low": values.astype(np.uint32)}


def values(name: str, column: np.ndarray) -> File:
    """Columns of one value per key."""
    if not len(column) or int(column.max()) < FULL:
        return {name: column.astype(np.uint8)}
    big = np.flatnonzero(column >= FULL)
    return {name: np.minimum(column, FULL).astype(np.uint8), f"{name}.at": narrow(big), f"{name}.is": narrow(column[big])}


def coded(name: str, columns: list[np.ndarray]) -> File:
    """Columns of several values per key, one byte for each of the most frequent rows of values, and a list of the others."""
    n = len(columns[0])
    wide = np.zeros(n, bool)
    key = np.zeros(n, np.uint64)
    for c in columns:
        wide |= c >= 1 << 12
        key = (key << np.uint64(12)) | np.minimum(c, (1 << 12) - 1).astype(np.uint64)
    found, back, counts = np.unique(key, return_inverse=True, return_counts=True)
    table = np.sort(np.argsort(-counts, kind="stable")[:FULL])
    code = np.full(len(found), FULL, np.uint8)
    code[table] = np.arange(len(table))
    own = np.where(wide, np.uint8(FULL), code[back].astype(np.uint8)) if n else np.zeros(0, np.uint8)
    rest = np.flatnonzero(own == FULL)
    mask = np.uint64((1 << 12) - 1)
    out = {name: own, f"{name}.at": narrow(rest)}
    for i, c in enumerate(columns):
        out[f"{name}.{i}"] = narrow(c[rest])
        out[f"{name}.table{i}"] = ((found[table] >> np.uint64(12 * (len(columns) - 1 - i))) & mask).astype(np.uint16)
    return out


def decoded(file: File, name: str, places: np.ndarray, n: int) -> np.ndarray:
    """(n, places) values of `coded` columns, as doubles."""
    code = file[name][places]
    other = np.flatnonzero(code == FULL)
    out = np.empty((n, len(places)))
    at = np.searchsorted(file[f"{name}.at"], places[other]) if len(other) else None
    for i in range(n):
        table = np.zeros(FULL + 1)
        table[: len(file[f"{name}.table{i}"])] = file[f"{name}.table{i}"]
        out[i] = table[code]
        if len(other):
            out[i, other] = file[f"{name}.{i}"][at]
    return out


def write(path: str, columns: File) -> None:
    """Write under a hidden name of its own, then rename: a repeated task replaces the file by equal bytes."""
    store, place = _store(path)
    store.create_dir(os.path.dirname(place), recursive=True)
    head = json.dumps({name: [c.dtype.str, len(c)] for name, c in columns.items()}).encode()
    hidden = f"{os.path.dirname(place)}/.{os.path.basename(place)}.{uuid.uuid4().hex}"
    with store.open_output_stream(hidden) as out:
        out.write(struct.pack("<Q", len(head)) + head + b" " * (-len(head) % 8))
        for c in columns.values():
            data = np.ascontiguousarray(c).tobytes()
            out.write(data + b"\0" * (-len(data) % 8))
    store.move(hidden, place)


def mapped(path: str) -> File:
    """The columns of a file, memory-mapped. A file in a remote store is copied to the worker's own disk first."""
    store, place = _store(path)
    if not isinstance(store, pafs.LocalFileSystem):
        with tempfile.NamedTemporaryFile() as copy:  # the mapping outlives the name
            with store.open_input_stream(place) as source:
                while part := source.read(1 << 22):
                    copy.write(part)
            copy.flush()
            return _columns(copy.name)
    return _columns(place)


def _columns(place: str) -> File:
    data = np.memmap(place, np.uint8, "r").view(np.ndarray)
    size = int(data[:8].view("<u8")[0])
    at, out = 8 + size + -size % 8, {}
    for name, (kind, n) in json.loads(bytes(data[8 : 8 + size])).items():
        width = np.dtype(kind).itemsize * n
        out[name] = data[at : at + width].view(kind)
        at += width + -width % 8
    return out


def find(file: File, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of wanted keys, and which of them are there."""
    if "key" in file:
        held = file["key"]
        if not len(held):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
        return at, held[at] == wanted
    bits = 8 * file["middle"].itemsize + 32
    top = (wanted >> np.uint64(bits)).astype(np.int64)
    low, high = file["start"][top].astype(np.int64), file["start"][top + 1].astype(np.int64)
    end, n = high.copy(), len(file["low"])
    rest = wanted & np.uint64((1 << bits) - 1)
    while (open_ := low < high).any():  # halving, for all keys at once
        middle = (low + high) >> 1
        at = np.minimum(middle, n - 1)
        below = open_ & (((file["middle"][at].astype(np.uint64) << np.uint64(32)) | file["low"][at]) < rest)
        low = np.where(below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
    at = np.minimum(low, n - 1)
    return at, (low < end) & (((file["middle"][at].astype(np.uint64) << np.uint64(32)) | file["low"][at]) == rest)


def take(file: File, name: str, places: np.ndarray) -> np.ndarray:
    """Values at places, as doubles."""
    out = file[name][places].astype(float)
    if f"{name}.at" in file:
        big = np.flatnonzero(out == FULL)
        out[big] = file[f"{name}.is"][np.searchsorted(file[f"{name}.at"], places[big])]
    return out
