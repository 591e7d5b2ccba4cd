"""Pairing the files of two directories by base name."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bagdiff import schema as S


def filter_names(files: DataFrame, needle: str | None) -> DataFrame:
    """Files whose stem contains ``needle`` (case-sensitive); empty keeps all."""
    if not needle:
        return files
    return files.where(F.col("stem").contains(F.lit(needle)))


def group_files(files: DataFrame) -> DataFrame:
    """``file_name, n_paths, n_left, n_right`` per base name, counted before they move."""
    return files.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n_paths"),
        F.count_if(F.col("side") == S.LEFT).cast("long").alias("n_left"),
        F.count_if(F.col("side") == S.RIGHT).cast("long").alias("n_right"),
    )


def grouped_paths(files: DataFrame) -> DataFrame:
    """``file_name, place, side, path``: the paths of each base name in order, one row each.

    ``place`` counts a name's distinct paths from 1, left before right, then by path. A path listed
    more than once is one. One row per path keeps a name that very many folders hold (``part-00000``)
    out of a single value; its paths are ordered by a window, which spills.
    """
    distinct = files.select("file_name", "side", "path").distinct()
    order = Window.partitionBy("file_name").orderBy(F.col("side") != S.LEFT, "path")
    return distinct.select("file_name", F.row_number().over(order).cast("long").alias("place"), "side", "path")


def pair_files(files: DataFrame) -> DataFrame:
    """``file_name, path_left, path_right`` for names held by exactly one distinct
    path on each side; other names are dropped (as the reference does, silently).
    A side has one path exactly if its smallest and its greatest are the same."""
    left = F.when(F.col("side") == S.LEFT, F.col("path"))
    right = F.when(F.col("side") == S.RIGHT, F.col("path"))
    per_name = files.groupBy("file_name").agg(
        F.min(left).alias("path_left"),
        F.max(left).alias("_l"),
        F.min(right).alias("path_right"),
        F.max(right).alias("_r"),
    )
    one_each = (F.col("path_left") == F.col("_l")) & (F.col("path_right") == F.col("_r"))
    return per_name.where(one_each).select("file_name", "path_left", "path_right")
