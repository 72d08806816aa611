"""Column helpers for text with the semantics of Python's string methods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as str.strip() sees it: Unicode white space and the four separators.
SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE))


def blank(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def content_hash(c: Column) -> Column:
    """SHA-256 of the stripped, lower-cased text."""
    return F.sha2(F.lower(strip(c)), 256)


def truncated(c: Column, n: int) -> Column:
    """The first n characters (code points)."""
    return F.substring(c, 1, n)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets: 1 if both are empty, 0 if one is."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, 1.0).otherwise(both / F.greatest(either, F.lit(1)))


def drawn(*seed: Column) -> Column:
    """A number below 2**32 that depends on nothing but its seeds: the first 8 hex digits of the MD5 of the seeds, joined by
    colons. Other engines can reproduce it."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[s.cast("string") for s in seed])), 1, 8), 16, 10).cast("long")
