"""Spectra of scatter matrices under rank-one updates, several streams at a time (numpy only).

A stream is (eigenvalues ascending, eigenvectors as columns). Adding the outer product of a vector turns, in the basis of
the eigenvectors, into a diagonal plus z z'. Entries of z that are too small to matter, and all but one of a group of equal
eigenvalues (turned into one entry by a reflection), are deflated: their pairs stay. The other eigenvalues are the roots of
the secular equation 1 + sum z_k^2 / (d_k - m) = 0, one between each two poles, found by rational steps inside brackets and
kept as distances from the nearest pole. The z that has exactly these roots gives orthogonal eigenvectors.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps


def reflected(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, tol: float) -> None:
    """Turn each group of equal eigenvalues so that z has one entry in it (one stream, in place)."""
    cut = np.flatnonzero(np.concatenate(([True], np.diff(values) > tol, [True])))
    for a, b in zip(cut[:-1], cut[1:]):
        if b - a > 1 and (norm := np.sqrt(z[a:b] @ z[a:b])) > 0:
            v = z[a:b].copy()
            v[-1] += np.copysign(norm, v[-1])
            vectors[:, a:b] -= np.outer(vectors[:, a:b] @ v, v * (2 / (v @ v)))
            z[a:b], z[b - 1] = 0.0, -np.copysign(norm, z[b - 1])


def roots(d: np.ndarray, squares: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each active i the root above d_i, and (k, i) the distances d_k - root_i (infinite for inactive k)."""
    total = squares.sum(axis=1, keepdims=True)
    after = np.minimum.accumulate(np.where(active, d, np.inf)[:, ::-1], axis=1)[:, ::-1]
    above = np.append(after[:, 1:], np.full((len(d), 1), np.inf), axis=1)
    width = np.where(np.isfinite(above), above - d, total * (1 + 4 * EPS))
    place = np.where(active, d, np.inf)
    # one row for each root: the poles' distances and weights
    stream, root = np.nonzero(active)
    last, span, start = ~np.isfinite(above[stream, root]), width[stream, root], d[stream, root]
    weight = squares[stream]
    middle = 1 + (weight / (place[stream] - start[:, None] - span[:, None] / 2)).sum(axis=1)
    right = (middle < 0) & ~last  # nearer to the pole above
    pole = place[stream] - np.where(right, above[stream, root], start)[:, None]
    first, second = np.where(right, -span, 0), np.where(right, 0, span)
    low, high = np.where(right, -span / 2, 0), np.where(right, 0, np.where(last, span, span / 2))
    own = np.tri(d.shape[1])[root]  # poles up to the root's own
    at, rows = (low + high) / 2, np.arange(len(root))
    held = (pole, weight, own, 1 - own, first, second, last, low, high)
    for _ in range(100):
        poles, weights, left, right_of, near, far, end, least, most = held
        now = at[rows]
        gap = poles - now[:, None]
        part = weights / gap
        slope = part / gap
        psi, psi_slope = np.einsum("mk,mk->m", part, left), np.einsum("mk,mk->m", slope, left)
        phi, phi_slope = np.einsum("mk,mk->m", part, right_of), np.einsum("mk,mk->m", slope, right_of)
        f = 1 + psi + phi
        least, most = np.where(f < 0, now, least), np.where(f < 0, most, now)
        a, b = near - now, far - now
        s, q = psi_slope * a * a, phi_slope * b * b
        c_own = 1 + psi - psi_slope * a
        c = c_own + phi - phi_slope * b
        p, r = c * (a + b) + s + q, c * a * b + s * b + q * a
        size = np.sqrt(np.maximum(p * p - 4 * r * c, 0))
        step = np.where(end, a + s / c_own, np.where(p <= 0, (p - size) / (2 * c), 2 * r / (p + size)))
        new = now + step
        new = np.where((new > least) & (new < most), new, (least + most) / 2)
        moves = np.abs(f) > EPS * (1 + np.abs(psi) + np.abs(phi))
        at[rows[moves]] = new[moves]
        open_ = moves & (np.abs(new - now) > 2 * EPS * np.abs(new))
        if not open_.any():
            break
        if open_.sum() < 0.8 * len(rows):
            rows, held = rows[open_], tuple(x[open_] for x in (poles, weights, left, right_of, near, far, end, least, most))
        else:
            held = (poles, weights, left, right_of, near, far, end, least, most)
    found, gaps = d.copy(), np.full((*d.shape, d.shape[1]), np.inf)
    found[stream, root] = np.where(right, above[stream, root], start) + at
    gaps[stream, :, root] = pole - at[:, None]
    return found, gaps


def add(values: np.ndarray, vectors: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spectra after each stream's scatter gained the outer product of its row. values (s, d), vectors (s, d, d), rows (s, d)."""
    z = (rows[:, None, :] @ vectors)[:, 0, :]
    size = np.sqrt((z * z).sum(axis=1))
    tol = 8 * EPS * np.maximum(values[:, -1], size * size)
    for i in np.flatnonzero((size > 0) & (np.diff(values, axis=1) <= 2 * tol[:, None]).any(axis=1)):
        reflected(values[i], vectors[i], z[i], 2 * tol[i])
    active = size[:, None] * np.abs(z) > tol[:, None]
    if not active.any():
        return values, vectors
    z = np.where(active, z, 0.0)
    with np.errstate(all="ignore"):  # inactive columns are replaced below
        found, gap = roots(values, z * z, active)
        between = values[:, :, None] - values[:, None, :]
        both = active[:, :, None] & active[:, None, :]
        ratio = np.where(both, gap / between, 1.0)
        index = np.arange(values.shape[1])
        ratio[:, index, index] = np.where(active, -gap[:, index, index], 0.0)
        z = np.copysign(np.sqrt(np.maximum(ratio.prod(axis=2), 0)), z)
        turn = np.where(both, z[:, :, None] / gap, 0.0)
        turn /= np.sqrt((turn * turn).sum(axis=1, keepdims=True))
    if not active.all():
        stream, column = np.nonzero(~active)
        turn[stream, :, column] = 0.0
        turn[stream, column, column] = 1.0
        found = np.where(active, found, values)
    values, vectors = found, vectors @ turn
    if not active.all():
        order = np.argsort(values, axis=1, kind="stable")
        values = np.take_along_axis(values, order, axis=1)
        vectors = np.take_along_axis(vectors, order[:, None, :], axis=2)
    return values, vectors


class Streams:
    """Centred scatter spectra of several streams of rows: counts, means, eigenvalues, eigenvectors."""

    def __init__(self, streams: int, length: int):
        self.n = np.zeros(streams)
        self.mean = np.zeros((streams, length))
        self.values = np.zeros((streams, length))
        self.vectors = np.repeat(np.eye(length)[None], streams, axis=0)

    def update(self, rows: np.ndarray) -> None:
        """One row to each of the first len(rows) streams."""
        m = len(rows)
        away = np.zeros_like(self.mean)
        away[:m] = rows - self.mean[:m]
        weight = np.sqrt(self.n / (self.n + 1))[:, None]
        self.values, self.vectors = add(self.values, self.vectors, away * weight)
        self.n[:m] += 1
        self.mean[:m] += away[:m] / self.n[:m, None]

    def merge(self, other: Streams) -> None:
        """Each stream takes the rows of the other's stream in: its eigenpairs one after the other, then the means' distance."""
        for i in range(self.mean.shape[1]):
            self.values, self.vectors = add(self.values, self.vectors, other.vectors[:, :, i] * np.sqrt(np.maximum(other.values[:, i], 0))[:, None])
        n = self.n + other.n
        away = other.mean - self.mean
        share = other.n / np.maximum(n, 1)
        self.values, self.vectors = add(self.values, self.vectors, away * np.sqrt(self.n * share)[:, None])
        self.mean += away * share[:, None]
        self.n = n

    def part(self, which) -> Streams:
        out = Streams.__new__(Streams)
        out.n, out.mean, out.values, out.vectors = (x[which] for x in (self.n, self.mean, self.values, self.vectors))
        return out

    def one(self) -> Streams:
        """All streams merged, in pairs."""
        at = self
        while len(at.n) > 1:
            half = len(at.n) // 2
            left, rest = at.part(slice(0, half)), at.part(slice(2 * half, None))
            left.merge(at.part(slice(half, 2 * half)))
            at = left if not len(rest.n) else together([left, rest])
        return at

    def packed(self) -> bytes:
        return np.concatenate([x.ravel() for x in (self.n, self.mean, self.values, self.vectors)]).astype("<f8").tobytes()


def together(parts: list[Streams]) -> Streams:
    out = Streams.__new__(Streams)
    out.n, out.mean, out.values, out.vectors = (np.concatenate(x) for x in zip(*((p.n, p.mean, p.values, p.vectors) for p in parts)))
    return out


def unpacked(data: bytes, length: int) -> Streams:
    """One stream."""
    flat = np.frombuffer(data, "<f8")
    out = Streams.__new__(Streams)
    out.n, out.mean, out.values = flat[:1].copy(), flat[1 : 1 + length].reshape(1, -1).copy(), flat[1 + length : 1 + 2 * length].reshape(1, -1).copy()
    out.vectors = flat[1 + 2 * length :].reshape(1, length, length).copy()
    return out
