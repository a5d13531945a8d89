"""Row keys and change hashes: NULL counts as ''."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _joined(cols: Sequence[Column], trim: bool) -> Column:
    texts = [F.trim(c.cast("string")) if trim else c.cast("string") for c in cols]
    return F.concat_ws("|", *[F.coalesce(t, F.lit("")) for t in texts])


def row_key(*cols: Column, trim: bool = True) -> Column:
    return F.md5(_joined(cols, trim))


def row_hash(*cols: Column, trim: bool = True) -> Column:
    return F.sha2(_joined(cols, trim), 256)
