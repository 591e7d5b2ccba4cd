"""File listing (S3) with base names and stems.

The listing comes from the file index that Spark builds on the driver for any file
source (``inputFiles()``). Unlike a scan's rows it includes empty files, which pair by
name as any other; no scan of Spark's returns them. So the driver holds one path per
file, as Spark itself does. Hidden files (``.x``, ``_x``) are skipped as by every Spark
file source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from bagdiff.functions.paths import base_name, clean_path, stem


def list_files(spark: SparkSession, paths: str | Sequence[str], side: str, recursive: bool = True) -> DataFrame:
    """``side, path, file_name, stem`` for every file under ``paths``."""
    reader = spark.read.format("text").option("recursiveFileLookup", str(recursive).lower())
    uris = reader.load([paths] if isinstance(paths, str) else list(paths)).inputFiles()
    raw = spark.createDataFrame([(side, u) for u in uris], "side string, uri string")
    return files_from_paths(raw.select("side", clean_path("uri").alias("path")))


def files_from_paths(df: DataFrame) -> DataFrame:
    """Add ``file_name`` and ``stem`` to a ``side, path`` DataFrame."""
    return df.select(
        "side",
        "path",
        base_name("path").alias("file_name"),
        stem("path").alias("stem"),
    )
