"""Writers over parquet: append, overwrite, idempotent slice replacement, snapshots, clustering, CSV.

Every writer goes through Spark's own commit protocol, so a lost executor only repeats its tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import assert_unique, schema_diff
from ..operators.updates import upsert, upsert_changed
from ..session import stored

OPEN_FILES = 8  # partition values that a writing task has open at once
BOM = "﻿"


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str]):
    writer = df.write.mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows grouped by partition value without one task per value: adaptive rebalancing splits hot values."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


@contextmanager
def unsorted(spark: SparkSession):
    """Writers inside send rows to the open files of their partition values as they come. Otherwise Spark first sorts all
    rows of a task by these values; now only those of a task with more than OPEN_FILES values are sorted."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _write(df: DataFrame, path: str, mode: str, partition_by: Sequence[str], **options: str) -> None:
    with unsorted(df.sparkSession):
        _writer(balanced(df, partition_by), mode, partition_by).options(**options).parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    _write(df, path, "append", partition_by)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Table whose files were written with growing schemas: the union of all columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def _file_system(spark: SparkSession, path: str):
    """(file system, function that makes its paths)."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full replacement including the schema.

    The new table is written beside the old one and takes its place by a rename, so readers meet one whole table or the
    other (or, between the two renames, none), and `df` may read `path` itself. A failed write leaves the old table as it
    was. Neighbours that begin with an underscore are left over only when the driver itself dies.
    """
    fs, make = _file_system(df.sparkSession, path)
    place = path.rstrip("/")
    parent, name = place.rsplit("/", 1)
    token = uuid.uuid4().hex
    staged, old = f"{parent}/_{name}.new-{token}", f"{parent}/_{name}.old-{token}"
    _write(df, staged, "errorifexists", partition_by)
    had = fs.exists(make(place))
    if had and not fs.rename(make(place), make(old)):
        fs.delete(make(staged), True)
        raise OSError(f"could not move {place} aside")
    if not fs.rename(make(staged), make(place)):
        if had:
            fs.rename(make(old), make(place))
        raise OSError(f"could not move the new table to {place}")
    if had:
        fs.delete(make(old), True)


def replace_all(df: DataFrame, path: str) -> None:
    overwrite(df, path)


def replace_slice(
    df: DataFrame, path: str, lot_column: str, lot: str, by: str | None = None, values: Sequence[str] = ()
) -> dict[str, int]:
    """Replace the rows of one lot (and of the listed values of a second column) by `df`; other rows stay.

    Layout: lot_column=.../by=.... Running it twice gives the same table. Values of the slice for which `df` has no
    rows end up empty. Returns the number of rows written, in total and per value.
    """
    watch = Observation()
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count_if(F.col(by) == v).alias(f"rows_{i}") for i, v in enumerate(values)]
    if by is None:
        out = df.where(F.col(lot_column) == lot).drop(lot_column).observe(watch, *counts)
        out.write.mode("overwrite").parquet(f"{path}/{lot_column}={lot}")
        return {"rows": watch.get["rows"]}
    out = df.where((F.col(lot_column) == lot) & F.col(by).isin(*values)).observe(watch, *counts)
    _write(out, path, "overwrite", [lot_column, by], partitionOverwriteMode="dynamic")
    got = watch.get
    for i, v in enumerate(values):
        if got[f"rows_{i}"] == 0:
            df.drop(lot_column, by).limit(0).write.mode("overwrite").parquet(f"{path}/{lot_column}={lot}/{by}={v}")
    return {"rows": got["rows"], **{v: got[f"rows_{i}"] for i, v in enumerate(values)}}


def read_partitioned(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame | None:
    """Partitioned table with its partition columns as text (all-digit values would be read as numbers); None if absent."""
    fs, make = _file_system(spark, path)
    if not fs.exists(make(path)):
        return None
    df = spark.read.parquet(path)
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def merge_slice(
    source: DataFrame, path: str, keys: Sequence[str], hash_column: str, partition_by: Sequence[str], slice_of: Mapping[str, str]
) -> dict[str, int]:
    """Change-only upsert into the partitions that match `slice_of` (e.g. one cycle); no other partition is touched.

    Only the slice of the stored table is read, and only its partitions are rewritten: the new files replace the old
    ones when the job commits. `source` must lie in the slice. Returns rows inserted and updated.
    """
    spark = source.sparkSession
    condition = F.lit(True)
    for column, value in slice_of.items():
        condition = condition & (F.col(column) == value)
    stored = read_partitioned(spark, path, partition_by)
    watch = Observation()
    if stored is None:
        merged = source.withColumn("_action", F.lit("insert"))
    else:
        merged = upsert_changed(stored.where(condition).select(*source.columns), source, keys, hash_column)
    actions = [F.count_if(F.col("_action") == a).alias(a) for a in ("insert", "update")]
    out = merged.observe(watch, *actions).drop("_action")
    _write(out, path, "overwrite", partition_by, partitionOverwriteMode="dynamic")
    return {a: watch.get[a] for a in ("insert", "update")}


def merge_buckets(source: DataFrame, path: str, keys: Sequence[str], hash_column: str, buckets: int = 256) -> dict[str, int]:
    """Change-only upsert by key into a table that is partitioned by a hash of the key (`_bucket`); read it with read_buckets.

    Only buckets with a source row are read, and only those with a new key or another hash are written; new files replace the
    old ones when the job commits, all others stay as they are, and running it twice changes nothing. `buckets` is fixed
    when the table is first written. Large buckets are several files. Returns rows inserted and updated.
    """
    spark = source.sparkSession
    assert_unique(source, keys, "upsert source")
    placed = stored(source.withColumn("_bucket", F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")), "merge")
    fs, make = _file_system(spark, path)
    watch = Observation()
    if not fs.exists(make(path)):
        first = placed.observe(watch, F.count(F.lit(1)).alias("insert"))
        _write(first, path, "errorifexists", ["_bucket"])
        return {"insert": watch.get["insert"], "update": 0}
    table = spark.read.parquet(path)
    met = [r["_bucket"] for r in placed.select("_bucket").distinct().collect()]  # at most `buckets`
    own = table.where(F.col("_bucket").isin(met)).select(*placed.columns)
    before = own.select(*keys, F.col(hash_column).alias("_was"), F.lit(True).alias("_there"))
    differs = F.col("_there").isNull() | (F.col(hash_column) != F.col("_was"))
    changed = placed.join(before, list(keys), "left").where(differs).select("_bucket").distinct()
    dirty = [r["_bucket"] for r in changed.collect()]
    if not dirty:
        return {"insert": 0, "update": 0}
    in_dirty = F.col("_bucket").isin(dirty)
    merged = upsert_changed(own.where(in_dirty), placed.where(in_dirty), keys, hash_column, check=False)
    out = merged.observe(watch, *[F.count_if(F.col("_action") == a).alias(a) for a in ("insert", "update")]).drop("_action")
    _write(out, path, "overwrite", ["_bucket"], partitionOverwriteMode="dynamic")
    return {a: watch.get[a] for a in ("insert", "update")}


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("_bucket")


def create_table_as(df: DataFrame, name: str) -> None:
    """Catalog table from a query, replacing an older one."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def bucketed(df: DataFrame, keys: Sequence[str], name: str | None = None, buckets: int | None = None) -> DataFrame:
    """Write df as a catalog table bucketed and sorted by `keys`, a file a bucket, and read it: joins and groups that contain
    the keys then need no exchange. By default a new table and as many buckets as shuffle partitions."""
    spark = df.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").format("parquet").option("compression", "zstd").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return spark.table(name)


RANK_BITS = 8


def _sortable(df: DataFrame, column: str) -> Column:
    """A number that orders like the column: numbers, dates and times as they are, text by its first seven bytes."""
    kind, c = dict(df.dtypes)[column], F.col(f"`{column}`")
    if kind == "string":
        head = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("long").cast("double")
    if kind == "date":
        return F.unix_date(c).cast("double")
    return (F.unix_micros(c) if kind == "timestamp" else c).cast("double")


def _rank(value: Column, bounds: Sequence[float]) -> Column:
    """How many of the ascending bounds are at most the value, by halving; NULL ranks first."""
    if not bounds:
        return F.lit(0)
    steps = [1 << b for b in reversed(range(len(bounds).bit_length()))]
    held = F.array(*[F.lit(b) for b in bounds])
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(F.get(held, at + s - 1) <= value, at + s).otherwise(at))


def cluster(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows in files that are small boxes in all the columns at once, so that a filter on any one of them prunes files.

    Each column's values are replaced by their quantile rank (of 256), and rows are range-partitioned and sorted by the
    interleaved bits of the ranks. One pass finds the quantiles; `df` is read again for the rows.
    """
    share = [i / (1 << RANK_BITS) for i in range(1, 1 << RANK_BITS)]
    values = df.select(*[_sortable(df, c).alias(f"v{i}") for i, c in enumerate(columns)])
    found = values.agg(*[F.percentile_approx(f"v{i}", share, 10_000).alias(f"b{i}") for i in range(len(columns))]).first()
    ranks = [_rank(_sortable(df, c), sorted(set(found[f"b{i}"] or ()))) for i, c in enumerate(columns)]
    place = F.lit(0).cast("long")
    for bit in reversed(range(RANK_BITS)):
        for r in range(len(ranks)):
            place = F.shiftleft(place, 1).bitwiseOR(F.shiftright(F.col(f"_r{r}"), bit).bitwiseAND(F.lit(1)).cast("long"))
    placed = df.select("*", *[r.alias(f"_r{i}") for i, r in enumerate(ranks)]).withColumn("_place", place)
    ranged = placed.repartitionByRange(files, "_place") if files else placed.repartitionByRange("_place")
    return ranged.sortWithinPartitions("_place", *columns).drop("_place", *[f"_r{i}" for i in range(len(ranks))])


def to_csv(df: DataFrame, path: str, sep: str = ";", bom: bool = False) -> None:
    """Delimited files with header; bom=True starts each file with a byte-order mark."""
    out = df.withColumnRenamed(df.columns[0], BOM + df.columns[0]) if bom else df
    out.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


# -- snapshots: a table that is rewritten from its own content --------------------------------------------------


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the completely written snapshots below `root`."""
    fs, make = _file_system(spark, root)
    if not fs.exists(make(root)):
        return []
    found = []
    for status in fs.listStatus(make(root)):
        name = status.getPath().getName()
        if name.startswith("v") and name[1:].isdigit() and fs.exists(make(f"{root}/{name}/_SUCCESS")):
            found.append(int(name[1:]))
    return sorted(found)


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    """Latest complete snapshot, or None before the first one."""
    versions = _versions(spark, root)
    return spark.read.parquet(f"{root}/v{versions[-1]:06d}") if versions else None


def write_snapshot(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Write the next snapshot beside the one being read. Readers switch when the job has committed.

    Fails when another writer has begun the same version.
    """
    spark = df.sparkSession
    versions = _versions(spark, root)
    path = f"{root}/v{(versions[-1] + 1 if versions else 1):06d}"
    _write(df, path, "errorifexists", partition_by)
    return path


def upsert_snapshot(source: DataFrame, root: str, keys: Sequence[str], hash_column: str | None = None) -> dict[str, int]:
    """Upsert into a snapshot table and report rows per action. With hash_column only changed rows are replaced."""
    target = read_snapshot(source.sparkSession, root)
    watch = Observation()
    if target is None:
        write_snapshot(source.observe(watch, F.count(F.lit(1)).alias("insert")), root)
        return {"insert": watch.get["insert"], "update": 0}
    if hash_column is None:
        write_snapshot(upsert(target, source, keys).observe(watch, F.count(F.lit(1)).alias("rows")), root)
        return {"rows": watch.get["rows"]}
    merged = upsert_changed(target, source, keys, hash_column)
    actions = [F.count_if(F.col("_action") == a).alias(a) for a in ("insert", "update")]
    write_snapshot(merged.observe(watch, *actions).drop("_action"), root)
    return {a: watch.get[a] for a in ("insert", "update")}


def ensure_schema(df: DataFrame, expected: Mapping[str, str] | Sequence[str]) -> tuple[bool, list[str], list[str]]:
    """(same, missing, extra): decide whether a stored table has to be rebuilt."""
    missing, extra = schema_diff(df, list(expected))
    return not missing and not extra, missing, extra
