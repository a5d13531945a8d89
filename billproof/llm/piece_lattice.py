"""Distinct sampled segmentations of texts into pieces of a SentencePiece model.

A text's segmentations are the paths of a lattice; a piece weighs (2 + its rank) ** -theta, and a path's probability is in
proportion to the product of its weights. Spaces only begin pieces, so the lattice is a chain of small lattices, one for
each chunk between them, and those are built once per worker: for each place the pieces that start there, with the
probabilities that sums over the rest of the chunk give them.

Samples are drawn without replacement by best-first (A*) search on perturbed log-probabilities. All paths have a Gumbel
maximum; descending from it piece by piece gives the first sample, and at every decision the alternatives left aside are a
region whose perturbed maximum is a Gumbel below its parent's. The best region left holds the next sample. After k samples
the best region left is the threshold that turns a sample's log-probability into its inclusion probability.

All random numbers are hashes of the row's key, the sample, the chunk and the step, so a row's samples don't depend on the
other rows, the partitioning or a repeated task.
"""

from __future__ import annotations

import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, hash_arrays

SPACE = "▁"
ODD = np.uint64(0x9E3779B97F4A7C15)
MUL = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
BASE = np.uint64(1_000_003)
BLOCK = 800_000
CACHED = 8_000_000  # pieces in the cached lattices
NEAR = 384  # decisions whose regions are looked at first
SHARES = 2.0**40  # shares are summed as whole numbers, so that a sum doesn't depend on the chunks learned with it


def uniform(seed: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit seeds."""
    x = seed * ODD
    x = (x ^ (x >> np.uint64(30))) * MUL[0]
    x = (x ^ (x >> np.uint64(27))) * MUL[1]
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(12)).astype(np.float64) * 2.0**-52 + 2.0**-54


class Growing:
    """An array that grows at its end without being copied each time; `data` has spare room behind the `n` values."""

    def __init__(self, dtype: type, data: np.ndarray | None = None):
        self.data = np.zeros(1024, dtype) if data is None else data.astype(dtype, copy=False)
        self.n = 0 if data is None else len(data)

    def add(self, values: np.ndarray) -> None:
        end = self.n + len(values)
        if end > len(self.data):
            wider = np.empty(max(end, len(self.data) * 3 // 2), self.data.dtype)
            wider[: self.n] = self.data[: self.n]
            self.data = wider
        self.data[self.n : end] = values
        self.n = end


def runs(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of several runs, one run after the other."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())


class Places(dict):
    """Chunks in the order they were met -> their number; those met since the last time are `new`."""

    def __init__(self, known: dict[str, int] | None = None):
        super().__init__(known or {})
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self.new.append(key)
        number = self[key] = len(self)
        return number


def scattered(at: np.ndarray, values: list[np.ndarray]) -> np.ndarray:
    out = np.empty(len(at), np.int64)
    out[at] = np.concatenate(values)
    return out


class Pieces:
    """The pieces of a model and the lattices of the chunks met so far.

    Chunks are kept up to a number of pieces; then those that weren't met again since the last time are dropped. What is
    kept has no influence on the samples.
    """

    CHUNKS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")

    def __init__(self, path: str, theta: float, most: int = CACHED):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=common.public_file(path))
        n = m.vocab_size()
        plain = [i for i in range(n) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        if any(SPACE in m.id_to_piece(i).lstrip(SPACE) or "\n" in m.id_to_piece(i) for i in plain):
            raise ValueError("a piece goes over a space or line break")
        self.bytes = {int(m.id_to_piece(i)[3:5], 16): i for i in range(n) if m.is_byte(i)}
        rank = np.full(n, float(n))
        rank[plain] = [-m.get_score(i) for i in plain]
        self.weight = -theta * np.log(2 + np.maximum(rank, 0))
        self.longest = max(len(m.id_to_piece(i)) for i in plain)
        begun: list[dict[int, list]] = [{} for _ in range(self.longest)]  # beginnings of pieces: hash -> id or -1, goes on
        for i in plain:
            value, piece = 0, m.id_to_piece(i)
            for k, c in enumerate(piece):
                value = (value * int(BASE) + ord(c)) & 0xFFFFFFFFFFFFFFFF
                entry = begun[k].setdefault(value, [-1, False])
                if k + 1 == len(piece):
                    entry[0] = i
                else:
                    entry[1] = True
        end = (0xFFFFFFFFFFFFFFFF, [-1, False])  # so that every search ends inside
        tables = [sorted([*v.items(), end]) for v in begun]
        self.table = [tuple(np.array(x, t) for x, t in zip(zip(*((h, *e) for h, e in v)), (np.uint64, np.int64, np.bool_))) for v in tables]
        letters = self.table[0][0][:-1].astype(np.int64)
        self.letter = np.full(letters.max() + 2, len(letters))  # of a code point: its place in the first table
        self.letter[letters] = np.arange(len(letters))
        data = [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n)]
        self.size = np.array(list(map(len, data)))
        self.offset = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(data), np.uint8)
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.place = Places()
        self.first, self.length = Growing(np.int64), Growing(np.int64)  # of a chunk: its first state, its code points
        self.again = Growing(np.bool_)  # the chunk was met after the block that it was learned for
        self.own_start, self.own_count, self.own = Growing(np.int64), Growing(np.int64), Growing(np.int32)  # the model's own ids
        self.start = Growing(np.int64, np.zeros(1, np.int64))  # of a state: its first edge; one more behind the last state
        self.key = Growing(np.float64)  # of an edge: cumulated probability up to its end
        self.id, self.span, self.log = Growing(np.int32), Growing(np.uint8), Growing(np.float32)  # id (or -1 - code point)
        self.extra: dict[int, list[int]] = {}

    def shrink(self) -> None:
        """Drop the chunks that weren't met again; of the others the first ones met, up to half of the bound, are kept."""
        kept = np.flatnonzero(self.again.data[: self.again.n])
        begin = self.first.data[kept]
        sizes = np.cumsum(self.start.data[begin + self.length.data[kept]] - self.start.data[begin])
        kept = kept[: np.searchsorted(sizes, self.most // 2, "right")]
        states = self.length.data[kept]
        from_state = runs(self.first.data[kept], states)
        edges = self.start.data[from_state + 1] - self.start.data[from_state]
        take = runs(self.start.data[from_state], edges)
        self.key, self.id, self.span, self.log = (Growing(x.data.dtype, x.data[take]) for x in (self.key, self.id, self.span, self.log))
        self.start = Growing(np.int64, np.concatenate(([0], np.cumsum(edges))))
        counts = self.own_count.data[kept]
        self.own = Growing(np.int32, self.own.data[runs(self.own_start.data[kept], counts)])
        self.own_start, self.own_count = Growing(np.int64, np.cumsum(counts) - counts), Growing(np.int64, counts)
        self.first, self.length = Growing(np.int64, np.cumsum(states) - states), Growing(np.int64, states)
        self.again = Growing(np.bool_, np.zeros(len(kept), np.bool_))
        names = list(self.place)
        self.place = Places({names[old]: new for new, old in enumerate(kept.tolist())})

    def chunks(self, text: str) -> list[str]:
        """Keys of a text's chunks. A key is the chunk behind one space, or \\0 and the chunk without one, or \\1 and the chunk."""
        if not text:
            return []
        if text[0] == " " or "  " in text or "\0" in text or "\1" in text or SPACE in text:
            return ["\1" + c for c in self.CHUNKS.findall(SPACE + text.replace(" ", SPACE))]
        return text.replace("\n", " \n \0").split(" ")

    @staticmethod
    def chunk(key: str) -> str:
        return key if key == "\n" else key[1:] if key[:1] in ("\0", "\1") else SPACE + key

    def learn(self, keys: list[str]) -> None:
        """Build the lattices of new chunks together."""
        chunks = [SPACE + key if key > "\x0b" else self.chunk(key) for key in keys]
        found = self.model.encode(["\n " + key if key > "\x0b" else "\n" + self.chunk(key).replace(SPACE, " ") for key in keys], num_threads=1)
        counts = np.fromiter(map(len, found), np.int64, len(found)) - 2  # without the model's own space and the \n
        own = np.fromiter(itertools.chain.from_iterable(found), np.int32, counts.sum() + 2 * len(found))
        self.own_start.add(self.own.n + np.cumsum(counts) - counts)
        self.own_count.add(counts)
        self.own.add(own[runs(np.cumsum(counts + 2) - counts, counts)])
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        codes = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).astype(np.uint64)
        n = len(codes)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)  # code points up to the chunk's end
        alive, rest, value = np.arange(n), left, np.zeros(n, np.uint64)
        state, span, ids, slot = [], [], [], []
        edges = np.zeros(n, np.int64)  # of a state
        for k, (hashes, piece_ids, goes_on) in enumerate(self.table, 1):
            value = value * BASE + codes[alive + (k - 1)]
            place = np.searchsorted(hashes, value) if k > 1 else self.letter[np.minimum(codes, len(self.letter) - 1).astype(np.int64)]
            same = hashes[place] == value
            here = np.where(same, piece_ids[place], -1)
            hit = np.flatnonzero(here >= 0)
            state.append(alive[hit])
            span.append(np.full(len(hit), k))
            ids.append(here[hit])
            slot.append(edges[state[-1]])
            edges[state[-1]] += 1
            if k == 1:
                none = alive[here < 0]
                state.append(none)
                span.append(np.ones(len(none), np.int64))
                ids.append(np.array([self.fallback(int(c)) for c in codes[none]], np.int64))
                slot.append(edges[none])
                edges[none] += 1
            go = np.flatnonzero(same & goes_on[place] & (rest > k))
            alive, rest, value = alive[go], rest[go], value[go]
            if not len(go):
                break
        places = np.argsort(hash_arrays.narrow(left), kind="stable")  # those with one code point left, then two, and so on
        count = edges[places]
        begin = np.cumsum(count) - count
        begun = np.empty(n, np.int64)
        begun[places] = begin
        at = np.concatenate([begun[x] + y for x, y in zip(state, slot)])
        span, ids = (scattered(at, x) for x in (span, ids))
        state = np.repeat(places, count)
        weight = self.weight[np.maximum(ids, 0)]
        for i in np.flatnonzero(ids < 0):
            weight[i] = self.weight[self.extra[int(ids[i])]].sum()
        ahead = np.where(span < left[state], state + span, n)
        cut = np.flatnonzero(np.diff(left[places], prepend=0, append=n + 1))
        total = np.zeros(n + 1)  # log of the summed weights from a place to the chunk's end
        for a, b in itertools.pairwise(cut.tolist()):
            at, to = begin[a], begin[b] if b < len(begin) else len(state)
            weight[at:to] += total[ahead[at:to]]
            sums, starts = weight[at:to], begin[a:b] - at
            top = np.maximum.reduceat(sums, starts)
            total[places[a:b]] = top + np.log(np.add.reduceat(np.exp(sums - np.repeat(top, count[a:b])), starts))
        logs = weight - total[state]
        share = np.exp(logs)
        bits = self.longest.bit_length()
        rough = np.rint((1 - np.minimum(share, 1)) * 65535).astype(np.int64)
        slot = np.arange(len(state)) - np.repeat(begin, count)  # rises with the span
        key = np.sort((((state << 16) | rough) << bits) | slot)  # a place's likely pieces first
        order = begun[key >> (16 + bits)] + (key & ((1 << bits) - 1))
        span, ids, logs, share = span[order], ids[order], logs[order], share[order]
        first = np.concatenate(([0], np.cumsum(edges)))
        whole = np.rint(share * SHARES).astype(np.int64)
        behind = np.cumsum(whole)
        if n:
            behind -= np.repeat((behind - whole)[first[:-1]], np.diff(first))
        behind = behind / SHARES
        behind[first[1:] - 1] = 1.0
        self.first.add(self.start.n - 1 + np.cumsum(sizes) - sizes)
        self.length.add(sizes)
        self.again.add(np.zeros(len(sizes), np.bool_))
        self.start.add(self.key.n + first[1:])
        for held, new in ((self.key, behind), (self.id, ids), (self.span, span), (self.log, logs)):
            held.add(new)

    def fallback(self, code: int) -> int:
        """The byte piece of a character without a piece; several bytes are one edge, with a number below zero."""
        found = [self.bytes[b] for b in chr(code).encode()]
        if len(found) == 1:
            return found[0]
        self.extra[-1 - code] = found
        return -1 - code

    def expanded(self, ids: np.ndarray) -> np.ndarray:
        if not len(ids) or ids.min() >= 0:
            return ids
        return np.array(list(itertools.chain.from_iterable(self.extra[i] if i < 0 else (i,) for i in ids.tolist())), np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids, without the space that the model puts in front."""
        size = self.size[ids]
        begin = np.cumsum(size) - size
        at = np.repeat(self.offset[ids] - begin, size) + np.arange(size.sum())
        return self.data[at].tobytes()[1:]

    def decodes(self, rows: list[np.ndarray], texts: list[bytes]) -> list[bool]:
        """Whether the ids of each row give its text."""
        if not rows:
            return []
        ids = np.concatenate(rows)
        size = self.size[ids]
        data = self.data[runs(self.offset[ids], size)].tobytes()
        ends = np.cumsum(np.append(0, size))[np.cumsum(list(map(len, rows)))].tolist()
        return [data[a + 1 : b] == t for a, b, t in zip([0, *ends], ends, texts)]

    def places(self, texts: list[list[str]]) -> list[np.ndarray]:
        if self.key.n > self.most:
            self.shrink()
        old = self.first.n
        sizes = list(map(len, texts))
        known = np.fromiter(map(self.place.__getitem__, itertools.chain.from_iterable(texts)), np.int64, sum(sizes))
        if self.place.new:
            self.learn(self.place.new)
            self.place.new = []
        self.again.data[known[known < old]] = True
        return np.split(known, np.cumsum(sizes, dtype=np.int64)[:-1])

    def best(self, chunks: np.ndarray) -> np.ndarray:
        """The model's own ids of chunks."""
        return self.own.data[runs(self.own_start.data[chunks], self.own_count.data[chunks])]


def worker_pieces(path: str, theta: float, cached: int = CACHED) -> Pieces:
    return common.held_by_worker(("pieces", path, theta, cached), lambda: Pieces(path, theta, cached))


def walk(p: Pieces, state: np.ndarray, left: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Draw pieces from each state to its chunk's end: number of decisions of each, and edge and state of all decisions in
    order. The arrays run along: states, code points left in the chunk, seed of the first decision."""
    start, key, span = p.start.data, p.key.data, p.span.data
    taken = np.zeros(len(state), np.int64)
    rounds = []
    on = np.flatnonzero(left > 0)
    state, left, seed = state[on], left[on], seed[on]
    while len(on):
        u = uniform(seed)
        edge = start[state]
        more = np.flatnonzero(key[edge] <= u)
        while len(more):  # the likely pieces stand first, so few rows go on
            edge[more] += 1
            more = more[key[edge[more]] <= u[more]]
        rounds.append((on, edge, state))
        taken[on] += 1
        step = span[edge]
        left = left - step
        go = np.flatnonzero(left > 0)
        on, left, state, seed = on[go], left[go], (state + step)[go], seed[go] + MUL[1]
    begin = np.cumsum(taken) - taken
    edges, states = np.empty(taken.sum(), np.int64), np.empty(taken.sum(), np.int64)
    for i, (on, edge, state) in enumerate(rounds):
        at = begin[on] + i
        edges[at], states[at] = edge, state
    return taken, edges, states


def region_values(p: Pieces, seeds: np.ndarray, logs: np.ndarray, edges: np.ndarray, states: np.ndarray, sizes: np.ndarray, barred: list[tuple[int, tuple]], values: np.ndarray) -> list[np.ndarray]:
    """Perturbed maxima of what the samples of rows leave aside at their decisions (`sizes` of each row, run along); none
    before a row's decision `where`, whose barred edges belong to earlier samples. Each is a Gumbel number at the region's
    log-probability, cut at the sample's own value."""
    starts = np.cumsum(sizes) - sizes
    aside = np.log(np.maximum(-np.expm1(np.minimum(logs, 0.0)), 1e-300))
    aside[p.start.data[states + 1] - p.start.data[states] == 1] = -np.inf
    mass = np.empty(len(logs))
    for at, n, (where, old) in zip(starts.tolist(), sizes.tolist(), barred):
        np.cumsum(logs[at : at + n], out=mass[at : at + n])
        if old:
            s, own = states[at + where], edges[at + where]
            rest = [e for e in range(p.start.data[s], p.start.data[s + 1]) if e != own and e not in old]
            aside[at + where] = np.logaddexp.reduce(p.log.data[rest].astype(float)) if rest else -np.inf
    mass = mass - logs + aside
    for at, (where, _) in zip(starts.tolist(), barred):
        mass[at : at + where] = -np.inf
    place = np.arange(len(logs)) - np.repeat(starts, sizes)
    noise = -np.log(uniform(np.repeat(seeds, sizes) + place.astype(np.uint64)))
    with np.errstate(over="ignore", invalid="ignore"):
        bound = mass - np.log(noise + np.exp(mass - np.repeat(values, sizes)))
    bound[np.isneginf(mass)] = -np.inf
    return [bound[at : at + n] for at, n in zip(starts.tolist(), sizes.tolist())]


def samples(p: Pieces, rows: list[np.ndarray], keys: list[str], k: int) -> list[tuple[list[tuple[np.ndarray, float, float]], float]]:
    """For each row its samples (ids, log-probability, perturbed value), best first, and the best value left.

    rows: chunk places. Round r walks all rows at once; a row's regions are kept as arrays over the decisions of a sample.
    """
    n = len(rows)
    seeds = np.array([xxhash.xxh64_intdigest(x) for x in keys], np.uint64)
    sizes = np.array(list(map(len, rows)), np.int64)
    flat = np.concatenate(rows) if n else np.zeros(0, np.int64)
    begin = np.cumsum(sizes) - sizes
    found: list[list[tuple]] = [[] for _ in range(n)]  # of a row: (chunks, edges, states, log-probability, value, barred edges, where)
    regions: list[list[np.ndarray]] = [[] for _ in range(n)]
    value = -np.log(-np.log(uniform(seeds)))
    start = [(0, 0, 0, 0)] * n  # chunk, state and code points left of a chunk begun, its steps so far
    heads: list[tuple | None] = [None] * n
    active = [i for i in range(n)]
    for r in range(k):
        salt = np.array([r + 1], np.uint64) * ODD  # an array: its products wrap
        if r == 0:
            state, left, owner = p.first.data[flat], p.length.data[flat], np.repeat(np.arange(n), sizes)
            chunk, step = np.arange(len(flat)) - np.repeat(begin, sizes), np.zeros(len(flat), np.int64)
        else:
            state, left, owner, chunk, step = [], [], [], [], []
            for i in active:
                at, begun, rest, steps = start[i]
                own = flat[begin[i] + at : begin[i] + sizes[i]]
                s, m = p.first.data[own], p.length.data[own]
                c, t = np.arange(at, sizes[i]), np.zeros(len(own), np.int64)
                s[0], m[0], t[0] = begun, rest, steps
                state.append(s)
                left.append(m)
                owner.append(np.full(len(own), i))
                chunk.append(c)
                step.append(t)
            state, left, owner, chunk, step = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (state, left, owner, chunk, step))
        seed = (seeds[owner] ^ salt) + chunk.astype(np.uint64) * MUL[0] + step.astype(np.uint64) * MUL[1]
        taken, edge, state = walk(p, state, left, seed)
        owner, chunk = np.repeat(owner, taken), np.repeat(chunk, taken)
        cut = np.searchsorted(owner, np.arange(n + 1)).tolist()
        nxt: list[int] = []
        whole = []  # of a row: chunks, edges and states of all decisions, head included
        for i in active:
            own = slice(cut[i], cut[i + 1])
            whole.append((chunk[own], edge[own], state[own]))
            if heads[i] is not None:
                whole[-1] = tuple(np.concatenate((a, b)) for a, b in zip(heads[i][0], whole[-1]))
        barring = [(0, ()) if heads[i] is None else heads[i][1:] for i in active]
        counts = np.array([len(w[1]) for w in whole], np.int64)
        every = p.log.data[np.concatenate([w[1] for w in whole]) if whole else edge].astype(float)
        logs_of = [every[b - m : b] for m, b in zip(counts.tolist(), np.cumsum(counts).tolist())]
        noise_seeds, values = seeds[active] + salt * MUL[1], value[active]

        def bounds(rows: list[int], most: list[int]) -> list[np.ndarray]:
            """region_values of some of the active rows, of the first decisions of each."""
            if not rows:
                return []
            logs, edges, states = (np.concatenate([x[j][:m] for j, m in zip(rows, most)]) for x in (logs_of, [w[1] for w in whole], [w[2] for w in whole]))
            size = np.array([min(m, counts[j]) for j, m in zip(rows, most)], np.int64)
            return region_values(p, noise_seeds[rows], logs, edges, states, size, [barring[j] for j in rows], values[rows])

        # the perturbed value of a region is below its mass + 38 (the noise has 54 bits), so far decisions can wait if
        # as many near ones as can still be asked for are above that
        nears = [max(where + 1, NEAR) for where, _ in barring]
        found_bounds = bounds(list(range(len(active))), nears)
        far = [
            j for j, (near, b, logs) in enumerate(zip(nears, found_bounds, logs_of)) if len(logs) > near and not np.partition(b, r - k)[r - k] > logs[:near].sum() + 40
        ]
        for j, b in zip(far, bounds(far, [int(counts[j]) for j in far])):
            found_bounds[j] = b
        for i, (chunks, edges, states), (where, barred), logs, bound in zip(active, whole, barring, logs_of, found_bounds):
            found[i].append((chunks, edges, states, float(logs.sum()), value[i], barred, where))
            regions[i].append(bound)
            tops = [b.max() if len(b) else -np.inf for b in regions[i]]
            best = int(np.argmax(tops))
            value[i] = tops[best]
            if tops[best] == -np.inf or r + 1 == k:
                continue
            where = int(np.argmax(regions[i][best]))
            regions[i][best][where] = -np.inf
            chunks, edges, states, _, _, old, place = found[i][best]
            barred = (*(old if place == where else ()), int(edges[where]))
            s = states[where]
            free = [e for e in range(p.start.data[s], p.start.data[s + 1]) if e not in barred]
            share = np.exp(p.log.data[free].astype(float))
            u = uniform((seeds[i : i + 1] ^ salt) * MUL[0])[0]
            pick = free[min(int(np.searchsorted(np.cumsum(share), u * share.sum(), "right")), len(free) - 1)]
            heads[i] = (tuple(np.append(a[:where], x) for a, x in ((chunks, chunks[where]), (edges, pick), (states, s))), where, barred)
            c, span = int(chunks[where]), int(p.span.data[pick])
            place = flat[begin[i] + c]
            steps = where - int(np.searchsorted(chunks, c)) + 1
            start[i] = (c, int(s) + span, int(p.first.data[place] + p.length.data[place]) - int(s) - span, steps)
            nxt.append(i)
        active = nxt
    return [([(p.expanded(p.id.data[s[1]].astype(np.int64)), s[3], float(s[4])) for s in own], float(v)) for own, v in zip(found, value)]


def inclusion(log_prob: float, left: float) -> float:
    """Probability that a segmentation is among the samples, given the threshold of the others."""
    return 1.0 if left == -np.inf else float(-np.expm1(-np.exp(min(log_prob - left, 700.0))))


SAMPLES = pa.list_(pa.struct([
    ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("log_prob", pa.float64()), ("score", pa.float64()), ("inclusion", pa.float64()), ("ids", pa.list_(pa.int32())),
]))
COLUMNS = (
    "key long, n_tokens long, ids_crc32 long, decoded boolean, "
    "samples array<struct<n_tokens: long, ids_crc32: long, log_prob: double, score: double, inclusion: double, ids: array<int>>>"
)


def segment(df: DataFrame, model: str, key: str = "doc_id", text: str = "text", k: int = 2, theta: float = 1.0, ids: bool = False, cached: int = CACHED) -> DataFrame:
    """The model's own encoding and k distinct sampled segmentations of each row, all decoded and compared with the text.

    Columns: key, n_tokens and ids_crc32 (of the model's own ids as little-endian 32-bit integers), decoded (every
    encoding gives the text back), samples: n_tokens, ids_crc32, log_prob, score (perturbed), inclusion and, if asked for,
    ids. A text with fewer than k segmentations has them all; an empty or null text has one, of no pieces. Rows with equal
    keys and texts get equal samples, a null key counts as the empty key; an empty table gives no rows; other columns
    aren't read. U+2581 is the model's space and decodes to one. cached: pieces that a worker keeps the lattices of; fewer take
    less memory and more time, and change no result.
    """
    schema = pa.schema([("key", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("decoded", pa.bool_()), ("samples", SAMPLES)])

    def crc(found: np.ndarray) -> int:
        return zlib.crc32(found.astype("<u4").tobytes())

    def offsets(sizes: np.ndarray) -> pa.Array:
        return pa.array(np.append(0, np.cumsum(sizes)), pa.int32())

    def block(p: Pieces, keys: list, texts: list[str]) -> pa.RecordBatch:
        rows = p.places([p.chunks(t) for t in texts])
        drawn = samples(p, rows, ["" if x is None else str(x) for x in keys], k)
        chunks = np.concatenate(rows)
        ends = np.cumsum(np.append(0, p.own_count.data[chunks]))[np.cumsum(list(map(len, rows)))]
        best = np.split(p.best(chunks), ends[:-1])
        want = [t.replace(SPACE, " ").encode() for t in texts]
        good = p.decodes(best, want)
        for i in range(k):
            which = [r for r, (several, _) in enumerate(drawn) if len(several) > i]
            for r, same in zip(which, p.decodes([drawn[r][0][i][0] for r in which], [want[r] for r in which])):
                good[r] = good[r] and same
        flat = [(s.astype("<i4"), log, g, left) for several, left in drawn for s, log, g in several]
        n_tokens = np.array([len(s) for s, *_ in flat], np.int64)
        listed = pa.ListArray.from_arrays(offsets(n_tokens), np.concatenate([s for s, *_ in flat])) if ids else pa.nulls(len(flat), pa.list_(pa.int32()))
        parts = [n_tokens, [zlib.crc32(s) for s, *_ in flat], [x[1] for x in flat], [x[2] for x in flat], [inclusion(log, left) for _, log, _, left in flat], listed]
        struct = pa.StructArray.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(parts, SAMPLES.value_type)], fields=list(SAMPLES.value_type))
        several = pa.ListArray.from_arrays(offsets(np.array([len(x) for x, _ in drawn], np.int64)), struct)
        return common.batch_of(schema, [keys, [len(own) for own in best], list(map(crc, best)), good, several])

    def run(batches: common.Batches) -> common.Batches:
        p = worker_pieces(model, theta, cached)
        for batch in common.slices(batches, 4000):
            keys, texts, size = [], [], 0
            for x, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(x)
                texts.append(t or "")
                size += len(texts[-1])
                if size >= BLOCK:
                    yield block(p, keys, texts)
                    keys, texts, size = [], [], 0
            if keys:
                yield block(p, keys, texts)

    return df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(run, COLUMNS)
