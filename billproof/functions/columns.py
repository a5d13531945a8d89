"""Helpers over column names: optional columns, header discovery, renaming. Driver metadata only."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_or(df: DataFrame, name: str, default: object = None, to: str = "string") -> Column:
    """The column when it exists, else a typed default."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(default).cast(to)


def find_column(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """First candidate that is present, ignoring case and outer blanks."""
    known = {c.strip().upper(): c for c in columns}
    for name in candidates:
        if name.upper() in known:
            return known[name.upper()]
    return None


def snake_case(name: str) -> str:
    return re.sub(r"_+", "_", re.sub(r"[^a-zA-Z0-9]+", "_", name.strip().lower())).strip("_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """All column names in lower snake case; two names that collide are an error."""
    names = [snake_case(c) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide after normalisation: {names}")
    return df.toDF(*names)


def project(df: DataFrame, mapping: Mapping[str, Column], order: Sequence[str] | None = None) -> DataFrame:
    """Ordered output projection; `order` also asserts that exactly these columns are produced."""
    if order is not None and set(order) != set(mapping):
        raise ValueError(f"projection and layout differ in {sorted(set(order) ^ set(mapping))}")
    return df.select(*[mapping[name].alias(name) for name in (order or mapping)])
