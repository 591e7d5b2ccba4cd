"""Explicit partitioning by key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def repartition_by_key(occ: DataFrame, num: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Hash-partition occurrences on ``by + key`` (Spark's non-negative hash), e.g.
    to reuse one partitioning across several comparisons of the same input."""
    cols = [*by, "key"]
    return occ.repartition(num, *cols) if num else occ.repartition(*cols)
