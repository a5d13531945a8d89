"""Word-level similarity of names, as higher-order functions on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC_WORD = r"^[.\-/\d]+$"


def _words(c: Column) -> Column:
    return F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != "")


def drop_number_runs(words: Column, max_digits: int = 4) -> Column:
    """Words without runs of consecutive numeric words that hold more than `max_digits` digits together."""
    empty = F.array().cast("array<string>")
    start = F.struct(empty.alias("kept"), empty.alias("run"))

    def flushed(acc: Column) -> Column:
        digits = F.length(F.regexp_replace(F.concat_ws("", acc["run"]), r"\D", ""))
        return F.when(digits <= max_digits, F.concat(acc["kept"], acc["run"])).otherwise(acc["kept"])

    def step(acc: Column, w: Column) -> Column:
        numeric = w.rlike(NUMERIC_WORD)
        one = F.array(w)
        return F.struct(
            F.when(numeric, acc["kept"]).otherwise(F.concat(flushed(acc), one)).alias("kept"),
            F.when(numeric, F.concat(acc["run"], one)).otherwise(empty).alias("run"),
        )

    return F.aggregate(words, start, step, flushed)


def _first_match(candidates: Column, w: Column) -> Column:
    """1-based position of the first candidate that equals w or is a prefix of it, or the other way round; else 0."""
    hits = F.transform(candidates, lambda v: w.startswith(v) | v.startswith(w))
    return F.coalesce(F.array_position(hits, F.lit(True)), F.lit(0)).cast("int")


def name_similarity(a: Column, b: Column) -> Column:
    """Matched words / words of the longer name, greedy one-to-one from left to right; NULL when a side is empty."""
    left, right = drop_number_runs(_words(a)), drop_number_runs(_words(b))
    start = F.struct(right.alias("rest"), F.lit(0).alias("hits"))

    def step(acc: Column, w: Column) -> Column:
        at = _first_match(acc["rest"], w)
        rest = F.concat(
            F.slice(acc["rest"], F.lit(1), F.greatest(at - 1, F.lit(0))),
            F.slice(acc["rest"], at + 1, F.size(acc["rest"])),
        )
        return F.struct(
            F.when(at > 0, rest).otherwise(acc["rest"]).alias("rest"),
            (acc["hits"] + F.when(at > 0, 1).otherwise(0)).alias("hits"),
        )

    hits = F.aggregate(left, start, step, lambda acc: acc["hits"])
    longest = F.greatest(F.size(left), F.size(right))
    usable = (F.coalesce(F.size(left), F.lit(0)) > 0) & (F.coalesce(F.size(right), F.lit(0)) > 0)
    return F.when(usable, hits.cast("double") / longest.cast("double"))
