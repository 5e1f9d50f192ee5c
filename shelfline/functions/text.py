"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def title_case(value: Column) -> Column:
    """Upper-case every letter that follows a non-letter (initcap only looks at blanks)."""
    pieces = F.regexp_extract_all(F.lower(value), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(pieces, F.initcap), "")


def contains_text(value: Column, needle: str) -> Column:
    """Case-insensitive containment as 0/1; null counts as 0."""
    return F.coalesce(F.contains(F.lower(value), F.lit(needle.lower())), F.lit(False)).cast("int")
