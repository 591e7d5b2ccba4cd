"""Comparison key and needle predicates.

All are built-in column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(text: str | Column, space_sensitive: bool = False, case_sensitive: bool = False) -> Column:
    """Key of a line: drop every U+0020 unless ``space_sensitive`` (tabs and other
    blanks stay), then lower-case unless ``case_sensitive``."""
    out = _col(text)
    if not space_sensitive:
        out = F.replace(out, F.lit(" "), F.lit(""))
    if not case_sensitive:
        out = F.lower(out)
    return out


def normalize_needle(needle: str, space_sensitive: bool = False, case_sensitive: bool = False) -> str:
    """The needle put through the same normalisation as keys (opt-in, see README)."""
    if not space_sensitive:
        needle = needle.replace(" ", "")
    if not case_sensitive:
        needle = needle.lower()
    return needle


def contains_needle(key: str | Column, needle: str | None) -> Column:
    """True where ``key`` contains ``needle`` as a plain substring; an empty or
    missing needle keeps everything."""
    if not needle:
        return F.lit(True)
    return _col(key).contains(F.lit(needle))
