"""Bucket rows as entries.

A bucket row lists one key's entries of that bucket in rank order, latest line
first, and bucket rows are sorted by their first entry. Rows are kept as one record
per entry at every size: ``position`` counts the entries from 1, and ``piece`` holds
the entry with ``[`` in front of the first, ``]`` after the last and ``,`` after any
other. A row's pieces in order, joined by one space, are the row's text. So no task
builds a row, however often a key occurs, and unpacking and slicing are filters.

``position`` and ``piece`` come from the counts and rank that the comparison gives. Each
entry learns its row's first entry from a join with the first entries, which are narrow;
Spark splits a row with very many entries over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bagdiff import schema as S
from bagdiff.functions.text import NUMBERED, entry_text, piece_text

#: Output order of the entries.
SORT_KEYS = ("bucket", "first_file", "first_line_no", "position")


def _placed(classified: DataFrame, by: list[str]) -> DataFrame:
    """Entries with their ``position`` among the ``n`` of their bucket row."""
    n_min = F.least("n_left", "n_right")
    differs = F.col("bucket").startswith("diff_")
    n_side = F.when(F.col("side") == S.LEFT, F.col("n_left")).otherwise(F.col("n_right"))
    file = F.col("file") if "file" in classified.columns else F.lit(None).cast("string")
    return classified.select(
        "bucket",
        *by,
        "key",
        (F.col("occ_rank") - F.when(differs, n_min).otherwise(F.lit(0))).cast("long").alias("position"),
        F.when(differs, n_side - n_min).otherwise(n_min).cast("long").alias("n"),
        F.col("occ_rank").cast("long").alias("occ_rank"),
        F.col("line_no").cast("long").alias("line_no"),
        "line",
        *([] if "file" in by else [file.alias("file")]),
    )


def first_entries(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``bucket, by..., key, first_file, first_line_no``: the first entry of every bucket row, straight from a comparison."""
    rows = _placed(classified, list(by)).where(F.col("position") == 1)
    return rows.select("bucket", *by, "key", F.col("file").alias("first_file"), F.col("line_no").alias("first_line_no"))


def bucket_entries(classified: DataFrame, by: Sequence[str] = (), fmt: str = NUMBERED) -> DataFrame:
    """``bucket, by..., key, first_file, first_line_no, position, n, occ_rank, line_no, line, file, piece``."""
    by = list(by)
    rows, firsts = _placed(classified, by), first_entries(classified, by)
    entry = entry_text(F.col("line_no"), F.col("line"), F.col("file"), fmt)
    rows = rows.withColumn("piece", piece_text(entry, F.col("position") == 1, F.col("position") == F.col("n")))
    return rows.join(firsts, ["bucket", *by, "key"])


def unpack_entries(entries: DataFrame) -> DataFrame:
    """One row per entry with its 1-based ``position`` in the bucket row (P10): the entries without their text form."""
    return entries.drop("piece")


def slice_entries(entries: DataFrame, start: int, length: int) -> DataFrame:
    """``length`` entries of each bucket row from 1-based ``start``."""
    return entries.where((F.col("position") >= start) & (F.col("position") < start + length))


def with_position(entries: DataFrame, range_bits: int = 20, firsts: DataFrame | None = None) -> DataFrame:
    """Add ``pos``: the 1-based place of the entry's bucket row inside its bucket.

    Rows are placed by their first entries alone, which are narrow: ``firsts`` (see
    :func:`first_entries`), else those among ``entries``, which were joined to them before. They are cut into
    ranges of ``2**range_bits`` consecutive first line numbers of a file, each range is
    counted, a window over the ranges of a file and one over the files of a bucket turn
    counts into offsets, and rows are ranked inside their range. No window holds more
    than a range, a file's ranges, or one row per file. Every step is a pure function of
    the rows, so a lost executor gives the same places.
    """
    head = ["bucket", "first_file", "first_line_no"]
    # a file name is a join key below: a missing one is the empty name
    named = F.coalesce(F.col("first_file"), F.lit("")).alias("first_file")
    heads = entries.where(F.col("position") == 1) if firsts is None else firsts
    heads = heads.select("bucket", named, "first_line_no")
    heads = heads.withColumn("_rng", F.shiftright("first_line_no", range_bits))
    in_file, in_bucket = ["bucket", "first_file"], ["bucket"]

    def before(size: str, keys: list[str], order: str):
        spec = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(size).over(spec), F.lit(0))

    ranges = heads.groupBy(*in_file, "_rng").agg(F.count(F.lit(1)).alias("_n"))
    files = ranges.groupBy(*in_file).agg(F.sum("_n").alias("_fn"))
    files = files.select(*in_file, before("_fn", in_bucket, "first_file").alias("_foff"))
    ranges = ranges.select(*in_file, "_rng", before("_n", in_file, "_rng").alias("_off")).join(files, in_file)
    in_range = Window.partitionBy(*in_file, "_rng").orderBy("first_line_no")
    placed = heads.join(ranges, [*in_file, "_rng"]).select(
        *head, (F.col("_foff") + F.col("_off") + F.row_number().over(in_range)).cast("long").alias("pos")
    )
    rows = entries.withColumn("_file", F.col("first_file")).withColumn("first_file", F.coalesce("first_file", F.lit("")))
    out = rows.join(placed, head)
    return out.withColumn("first_file", F.col("_file")).select(*entries.columns, "pos")
