"""Embedding near-dedup: spherical k-means cells, blocked cosine products inside cells, one representative a group.

Equal vectors are one row with a count. Centres are fitted on a bounded sample; then every vector gets its home, the cell
of the centre with the greatest cosine. A vector within angle t of the plane between its home and another centre can have a
partner there (t: the angle of the least cosine), so it is also sent as a guest to each such cell with a higher number: for
unit centres c, d that is v(c - d) <= sin(t)|c - d|. No link is lost, whatever the cells. How many cells are fitted is read
off the sample, as the number that costs the least work: clustered vectors get many cells with few guests, and vectors
without any direction few cells, as every cell then borders on most others and no exact method avoids comparing most pairs.

A cell's residents are dealt into chunks. A group compares one chunk with itself and with a bounded part of the cell's later
chunks and guests, which stream by in strips; a large cell is many groups. Products are taken in single precision, and
whatever comes near the least cosine again in double precision. A strip emits the number of links of each row and one link
from each linked row to a representative, never its pairs.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, vectors

SAMPLE = 16_384  # vectors the centres are fitted on, or fewer that fit SAMPLE_BYTES
SAMPLE_BYTES = 32 << 20
CHUNK = 4_096  # residents held by a task
STREAM = 65_536  # rows that pass by a chunk in one group
STRIP = 512
SENT = 200  # cost of sending a row, in products


def fit(rows: np.ndarray, k: int, seed: int = 42, rounds: int = 10) -> np.ndarray:
    """k unit centres of unit rows by spherical k-means; empty cells keep their centre."""
    centres = rows[np.random.default_rng(seed).choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        home = (rows @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, home, rows)
        norm = np.sqrt((total * total).sum(axis=1, keepdims=True))
        centres = np.where(norm > 1e-12, total / np.maximum(norm, 1e-300), centres)
    return centres


def borders(centres: np.ndarray, least: float) -> np.ndarray:
    """(k, k): how far a vector's product with its home may exceed that with another centre for a partner to be there."""
    apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
    return math.sqrt(max(0.0, 1 - least * least)) * apart + 1e-9


def visits(rows: np.ndarray, centres: np.ndarray, border: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """home of each row; (row, k) whether it is a guest of a cell."""
    near = rows @ centres.T
    home = near.argmax(axis=1)
    guest = near[np.arange(len(rows)), home][:, None] - near <= border[home]
    return home, guest & (np.arange(len(centres)) > home[:, None])


def work(rows: np.ndarray, centres: np.ndarray, least: float, n: int) -> float:
    """Estimated cost of each of n vectors like the sample's rows: products and rows sent."""
    border, k = borders(centres, least), len(centres)
    residents, guests = np.zeros(k), np.zeros(k)
    for at in range(0, len(rows), 1024):
        home, guest = visits(rows[at : at + 1024], centres, border)
        residents += np.bincount(home, minlength=k)
        guests += guest.sum(axis=0)
    scale = n / len(rows)
    residents, guests = residents * scale, guests * scale
    chunks = np.ceil(residents / CHUNK)
    sent = (guests * chunks + residents * (chunks + 1) / 2).sum()
    return k + ((residents * (residents / 2 + guests)).sum() + SENT * sent) / n


def fitted(rows: np.ndarray, least: float, n: int, cells: int | None = None) -> np.ndarray:
    """Centres for n vectors, by the sample's unit rows: as many as `cells`, or the cheapest of the powers of four."""
    most = max(1, len(rows) // 16)
    tried = [min(cells, len(rows))] if cells else [4**i for i in range(0, 7) if 4**i <= most]
    found = [fit(rows, k) for k in tried]
    return found[0] if len(found) == 1 else min(found, key=lambda c: work(rows, c, least, n))


def sampled(distinct: DataFrame, length: int, n: int, most: int) -> np.ndarray:
    """At most `most` vectors of the usual length, by hash."""
    most = max(1, min(most, SAMPLE_BYTES // (8 * max(length, 1))))
    spread = F.pmod(F.xxhash64(F.lit("sample"), "v"), F.lit(1 << 40))
    chosen = distinct.where((F.size("v") == length) & (spread < int(min(1.0, 1.25 * most / max(n, 1)) * (1 << 40))))
    found = chosen.orderBy(spread, "id").limit(most).select("v").toArrow()
    return vectors.units(vectors.matrix(found["v"].combine_chunks(), length))


def cells_of(batch: pa.RecordBatch, centres: np.ndarray, border: np.ndarray):
    """(rows, home, guest) of parts of a batch; vectors of another length have a cell of their own for each length."""
    column = batch.column(batch.schema.get_field_index("v"))
    sizes, (k, length) = vectors.lengths(column), centres.shape
    usual = np.flatnonzero(sizes == length)
    for at in range(0, len(usual), 1024):
        own = usual[at : at + 1024]
        yield own, *visits(vectors.units(vectors.matrix(column.take(pa.array(own)), length)), centres, border)
    other = np.flatnonzero(sizes != length)
    if len(other):
        yield other, k + sizes[other], np.zeros((len(other), k), bool)


def counted(distinct: DataFrame, centres: np.ndarray, border: np.ndarray) -> dict[int, tuple[int, int]]:
    """cell -> residents, guests."""
    schema = pa.schema([("cell", pa.int64()), ("residents", pa.int64()), ("guests", pa.int64())])
    sent = distinct.sparkSession.sparkContext.broadcast((centres, border))

    def run(batches: common.Batches) -> common.Batches:
        total: dict[int, list[int]] = {}
        for batch in batches:
            for _, home, guest in cells_of(batch, *sent.value):
                for i, cells in enumerate((home, np.nonzero(guest)[1])):
                    for c, m in zip(*(x.tolist() for x in np.unique(cells, return_counts=True))):
                        total.setdefault(c, [0, 0])[i] += m
        yield common.batch_of(schema, [list(total), [t[0] for t in total.values()], [t[1] for t in total.values()]])

    found = distinct.select("v").mapInArrow(run, "cell long, residents long, guests long")
    return {r[0]: (r[1], r[2]) for r in found.groupBy("cell").agg(F.sum("residents"), F.sum("guests")).collect()}


def dealt(distinct: DataFrame, centres: np.ndarray, border: np.ndarray, chunk: int, stream: int) -> DataFrame:
    """cell, x, y, passing, id, n, v: the rows of each group, first the chunk x, then part y of the rows that pass by."""
    counts = counted(distinct, centres, border)
    chunks = {c: max(1, -(-m // chunk)) for c, (m, _) in counts.items()}
    parts = {c: max(1, -(-(m + g) // stream)) for c, (m, g) in counts.items()}
    spark, kind = distinct.sparkSession, dict(distinct.dtypes)["v"]
    sent = spark.sparkContext.broadcast((centres, border, chunks, parts))
    value = pa.float32() if kind == "array<float>" else pa.float64()
    schema = pa.schema([("cell", pa.int64()), ("x", pa.int32()), ("y", pa.int32()), ("passing", pa.int32()), ("id", pa.int64()), ("n", pa.int64()), ("v", pa.list_(value))])

    def run(batches: common.Batches) -> common.Batches:
        centres, border, chunks, parts = sent.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            deal = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
            for own, home, guest in cells_of(batch, centres, border):
                out = []
                for row, c in zip(own.tolist(), home.tolist()):
                    x, y = int(deal[row]) % chunks[c], int(deal[row] >> np.uint64(20)) % parts[c]
                    out += [(row, c, x, part, 0) for part in range(parts[c])]
                    out += [(row, c, earlier, y, 1) for earlier in range(x)]
                for i, c in zip(*(a.tolist() for a in np.nonzero(guest))):
                    row = int(own[i])
                    y = int(deal[row] >> np.uint64(20)) % parts[c]
                    out += [(row, c, x, y, 1) for x in range(chunks.get(c, 0))]
                for at in range(0, len(out), 4096):
                    rows, *place = (list(z) for z in zip(*out[at : at + 4096]))
                    part = batch.take(pa.array(rows))
                    yield common.batch_of(schema, [*place, part.column(0), part.column(1), part.column(2)])

    rows = distinct.select("id", "n", "v").mapInArrow(run, f"cell long, x int, y int, passing int, id long, n long, v {kind}")
    return rows.repartition("cell", "x", "y").sortWithinPartitions("cell", "x", "y", "passing", "id")


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest number that each of 0 .. n - 1 is joined with by the links a - b."""
    root = np.arange(n)
    while True:
        p, q = root[a], root[b]
        live = p != q
        if not live.any():
            return root
        a, b, p, q = a[live], b[live], p[live], q[live]
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        while (up := root[root]).tolist() != root.tolist():
            root = up


def linked(one: tuple, two: tuple, least: float, above: int | None = None):
    """id, label, links of the rows of two blocks (ids, counts, unit rows) that are linked with a row of the other.

    above: the blocks are a chunk and a strip of it that begins at this row, of which pairs count once.
    """
    (ids, n, rows), (other_ids, other_n, others) = one, two
    near = rows.astype(np.float32) @ others.astype(np.float32).T >= np.float32(least - 1e-4)
    if above is not None:
        near &= np.arange(len(ids))[:, None] < above + np.arange(len(other_ids))
    mine, theirs = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    if not len(mine):
        return None
    a, b = np.nonzero((rows[mine] @ others[theirs].T >= least) & near[np.ix_(mine, theirs)])
    if not len(a):
        return None
    mine_n, theirs_n = n[mine], other_n[theirs]
    links = np.append(np.bincount(a, theirs_n[b], len(mine)), np.bincount(b, mine_n[a], len(theirs)))
    if above is not None:  # the same row may stand on both sides
        key, back = np.unique(np.append(mine, above + theirs), return_inverse=True)
        all_ids, links = ids[key], np.bincount(back, links)
        a, b = back[a], back[len(mine) + b]
    else:
        all_ids, b = np.append(ids[mine], other_ids[theirs]), len(mine) + b
    label = all_ids[roots(a, b, len(all_ids))]
    there = links > 0
    return all_ids[there], label[there], links[there].astype(np.int64)


def links(groups: DataFrame, least: float) -> DataFrame:
    """id, label, n: rows of a strip with links, a representative they reach, and how many vectors they are linked with."""
    schema = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("n", pa.int64())])

    def block(batch: pa.RecordBatch) -> tuple:
        column = batch.column(6)
        return batch.column(4).to_numpy(), batch.column(5).to_numpy(), vectors.units(vectors.matrix(column, int(vectors.lengths(column)[0])))

    def joined(parts: list[tuple]) -> tuple:
        return tuple(np.concatenate(x) for x in zip(*parts))

    def run(batches: common.Batches) -> common.Batches:
        now, held, chunk = None, [], None
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                pieces = [(None, 0, None)]
            else:
                places = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
                cut = np.flatnonzero(np.concatenate(([True], (places[1:] != places[:-1]).any(axis=1), [True])))
                pieces = [(tuple(places[a, :3].tolist()), int(places[a, 3]), batch.slice(a, b - a)) for a, b in zip(cut[:-1], cut[1:])]
            for group, passing, part in pieces:
                if held and (group != now or passing):  # the chunk is whole
                    chunk, held = joined(held), []
                    if now[2] == 0:
                        for at in range(0, len(chunk[0]), STRIP):
                            found = linked(tuple(x[: at + STRIP] for x in chunk), tuple(x[at : at + STRIP] for x in chunk), least, at)
                            if found:
                                yield common.batch_of(schema, list(found))
                if group != now:
                    now, chunk = group, None
                if part is None:
                    continue
                if not passing:
                    held.append(block(part))
                elif chunk is not None:
                    for at in range(0, part.num_rows, STRIP):
                        found = linked(chunk, block(part.slice(at, STRIP)), least)
                        if found:
                            yield common.batch_of(schema, list(found))

    return groups.mapInArrow(run, "id long, label long, n long")


def near_duplicates(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.95, cells: int | None = None,
    sample: int = SAMPLE, chunk: int = CHUNK, stream: int = STREAM,
) -> DataFrame:
    """key long, n_links long, component_id long, kept boolean for each row of df.

    Vectors link when their cosine is `least` (above 0) or more. Vectors that are null, empty, zero or hold null or non-finite
    entries link with nothing; vectors of different lengths don't link. Every row counts as a vector, repeated rows and keys
    too. Rows with a null key have links, but give a component no key; a component without any key is null. kept: the key is
    the component's. An empty table gives an empty result; other columns of df are not read.
    """
    if not 0 < least <= 1:
        raise ValueError("the least cosine is above 0 and at most 1")
    kind = "array<float>" if dict(df.dtypes)[vector] == "array<float>" else "array<double>"
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(vector).cast(kind).alias("v"))
    usable = vectors.whole(F.col("v")) & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("ok", usable)
    distinct = rows.where("ok").groupBy("v").agg(F.count("*").alias("n"), F.min("key").alias("least"))
    distinct = common.stored(distinct.withColumn("id", F.monotonically_increasing_id()), "vectors")
    usual = distinct.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    if usual is None:
        return rows.select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"), F.lit(True).alias("kept"))
    centres = fitted(sampled(distinct, usual["length"], usual["count"], sample), least, usual["count"], cells)
    found = common.stored(links(dealt(distinct, centres, borders(centres, least), chunk, stream), least), "vector-links")

    counts = found.groupBy("id").agg(F.sum("n").alias("links"))
    edges = found.where("id <> label").select(F.col("id").alias("a"), F.col("label").alias("b"))
    reached = distinct.join(counts, "id", "left").join(common.components(edges).withColumnRenamed("node", "id"), "id", "left")
    reached = reached.withColumn("root", F.coalesce("root", "id")).withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("n") - 1)
    component = reached.groupBy("root").agg(F.min("least").alias("component_id"))
    of_vector = reached.select("v", "root", "n_links").join(component, "root").select("v", "n_links", "component_id")
    linked_rows = rows.where("ok").join(of_vector, "v").select("key", "n_links", "component_id")
    rest = rows.where("NOT ok").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return linked_rows.unionByName(rest).withColumn("kept", F.col("key").eqNullSafe(F.col("component_id")))
