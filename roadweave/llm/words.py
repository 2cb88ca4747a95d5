"""Shared column expressions over texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else kept."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words of a text, in order; empty array for null or blank."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def unit(seed: int, *cols: Column) -> Column:
    """A reproducible draw from (0, 1) for a row's identity: 52 bits of an MD5 digest."""
    key = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols])
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))
