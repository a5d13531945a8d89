"""Readers: tables, bulk dumps, sheets, pipe-delimited directories, small row lists, and run parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, LongType, StringType, StructField, StructType

from ..functions.dates import cycle_to_lot
from ..functions.text import NULL_TOKENS, is_null_token, null_tokens, trimmed


def table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table, or parquet folder when the name holds a slash."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def sql_source(spark: SparkSession, text: str, limit: int | None = None, **views: DataFrame) -> DataFrame:
    """Source defined by SQL over the given DataFrames; `limit` is for trial runs."""
    out = spark.sql(text, **views) if views else spark.sql(text)
    return out if limit is None else out.limit(limit)


def read_dump(spark: SparkSession, path: str, fmt: str, sep: str = ";", schema: StructType | None = None) -> DataFrame:
    """Bulk file: csv (header, latin-1), parquet, or a catalog table."""
    if fmt == "csv":
        reader = spark.read.option("header", True).option("sep", sep).option("encoding", "ISO-8859-1")
        return (reader.schema(schema) if schema else reader).csv(path)
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt in ("table", "delta"):
        return spark.table(path)
    raise ValueError(f"unknown dump format {fmt!r}: use csv, parquet or table")


def sniff_separator(header: str) -> str:
    """The separator that occurs most often in a header line; ';' when none occurs."""
    counts = {s: header.count(s) for s in (";", ",", "\t", "|")}
    best = max(counts, key=counts.get)
    return best if counts[best] else ";"


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header, UTF-8 with or without a byte-order mark, separator sniffed from the header, all strings."""
    first = spark.read.text(path).limit(1).collect()
    header = first[0][0].lstrip("﻿") if first else ""
    df = spark.read.option("header", True).option("sep", sniff_separator(header)).option("inferSchema", False).csv(path)
    return df.toDF(*[c.lstrip("﻿").strip().strip('"') for c in df.columns])


def read_pipe(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Headerless pipe-delimited latin-1 file with given column names, all strings."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.read.schema(schema).option("sep", "|").option("encoding", "ISO-8859-1").option("quote", "").csv(path)


def read_csv(spark: SparkSession, path: str, sep: str = ",", schema: StructType | None = None) -> DataFrame:
    """CSV with header; types are inferred (one extra pass) unless a schema is given."""
    reader = spark.read.option("header", True).option("sep", sep)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def coerce(df: DataFrame, types: Mapping[str, DataType]) -> DataFrame:
    """Text columns to long, double or boolean; literal nulls and unreadable values become NULL."""
    columns = []
    for name in df.columns:
        raw = F.col(f"`{name}`")
        kind = types.get(name, StringType())
        text = null_tokens(raw, "registry")
        if isinstance(kind, BooleanType):
            lowered = F.lower(trimmed(raw))
            known_null = is_null_token(raw, "registry") | lowered.isin(*sorted({t.lower() for t in NULL_TOKENS["registry"]}))
            value = F.when(~known_null, ~lowered.isin("false", "0"))
        elif isinstance(kind, LongType):
            value = text.try_cast("double").cast("bigint")
        elif isinstance(kind, DoubleType):
            value = text.try_cast("double")
        else:
            value = F.when(~raw.cast("string").isin(*NULL_TOKENS["registry"]), raw.cast("string"))
        columns.append(value.alias(name))
    return df.select(*columns)


def to_df(spark: SparkSession, rows: Sequence[Mapping], types: Mapping[str, DataType] | None = None) -> DataFrame:
    """Typed DataFrame from a small list of records (parameters, fixtures); values may be text."""
    names = list(dict.fromkeys(k for row in rows for k in row))
    schema = StructType([StructField(n, StringType()) for n in names])
    data = [tuple(None if row.get(n) is None else str(row.get(n)) for n in names) for row in rows]
    return coerce(spark.createDataFrame(data, schema), types or {})


def latest_lot_df(df: DataFrame, column: str, name: str = "lot") -> DataFrame:
    """One row with the latest lot."""
    return df.agg(F.max(column).alias(name))


def latest_lot(df: DataFrame, column: str, fallback: str) -> str:
    """Latest lot 'yyyy-MM' as a run parameter; `fallback` for an empty table."""
    return latest_lot_df(df, column).first()[0] or cycle_to_lot(fallback)
