"""Helpers shared by the training-data operators: tables, shared folders, Arrow maps, range buckets, components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Where the setting is missing a local run (one machine, as in tests) gets a temporary folder; a cluster is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    """Each query that runs inside frees its shuffle files as soon as it ends, not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


_held: dict = {}


def held_by_worker(key: tuple, make: Callable):
    """A look-up that a Python worker keeps over its tasks. It holds one at a time, so stages don't add up their caches."""
    if key not in _held:
        if _held:
            _held.clear()
            give_back()
        _held[key] = make()
    return _held[key]


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def slices(batches: Batches, rows: int = 1000) -> Batches:
    """Batches of fewer rows, so that what is made of one doesn't pile up."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes; null counts as the empty text."""
    return [x or b"" for x in batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()]


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def public_file(name: str) -> str:
    """The place of a vocabulary file on this machine: a path as it is, a bare name among the public tokenizers' files."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def constant(values: list, kind: str = "bigint") -> Column:
    """A list as a constant array that the optimizer folds; one expression however long it is."""
    return F.split(F.lit(" ".join(map(repr, values))), " ").cast(f"array<{kind}>") if values else F.array().cast(f"array<{kind}>")


def below(bounds: list[int], key: Column) -> Column:
    """How many of the ascending bounds are <= key (0 for a null key): a binary search in column functions."""
    steps, step = [], 1
    while step <= len(bounds):
        steps.insert(0, step)
        step *= 2
    if not steps:
        return F.lit(0)
    values = constant(bounds)
    return F.aggregate(F.lit(steps), F.lit(0), lambda at, s: F.when(F.get(values, at + s - 1) <= key, at + s).otherwise(at))


def range_bounds(df: DataFrame, key: str, rows: int, most: int = 1 << 16) -> list[int]:
    """Ascending cut points that deal the rows into key ranges of about `rows` each, or of more rows where that would be more
    than `most` ranges: 65,536 of them are about as many partitions as a shuffle should have, and 1.6 GB each at 100 TB."""
    n = df.agg(F.count(key).alias("n")).first()["n"]
    k = max(1, min(most, math.ceil(n / rows)))
    if k == 1:
        return []
    share = [i / k for i in range(1, k)]
    found = df.agg(F.percentile_approx(key, constant(share, "double"), max(10_000, 10 * k)).alias("b")).first()["b"]
    return sorted(set(found))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of `edges` (a long, b long, undirected): node long, root long (the smallest node reachable).

    Alternates large-star and small-star steps; each step is two aggregates by key and is written to the shared folder,
    so that nothing is collected and a lost executor costs one step. Nodes without an edge don't appear.
    """

    def both(e: DataFrame) -> DataFrame:
        return e.union(e.select("b", "a"))

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())

    links = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components"
    )
    was = state(links)
    for _ in range(most_rounds):
        if was[0] == 0:
            break
        pairs = both(links)
        least = pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = pairs.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        links = stored(small.where("a <> b").distinct(), "components")
        now = state(links)
        if now == was:
            break
        was = now
    else:
        raise RuntimeError(f"components did not settle within {most_rounds} rounds")
    nodes = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return nodes.union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
