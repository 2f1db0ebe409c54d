"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
from contextlib import suppress

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.storage import ship  # noqa: F401  used by the operators
from tramline.functions.storage import stored as materialise  # noqa: F401

#: Fixed value: the blank characters between words (space, TAB, LF, VT, FF, CR), as a regex class body.
BLANK = r"\x20\x09-\x0D"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Array of words (maximal runs of non-blank characters); null text gives an empty array."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{BLANK}]+")
    return F.filter(parts, lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def unit_interval(*parts: Column | str | int) -> Column:
    """Uniform double in (0, 1) that is a pure function of the given values."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    bits = F.shiftrightunsigned(F.xxhash64(*cols), 11)
    return (bits.cast("double") + 0.5) / float(2**53)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row, also where the body's own lambdas use it again and again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def give_back() -> None:
    """Hands freed memory back to the system, where the C library can; an idle Python worker would else keep what its largest batch took."""
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)
