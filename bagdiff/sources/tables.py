"""Occurrences from a text column of any DataFrame (the table adapter) and the
empty occurrence set (S6).

Line numbers run per (side, file) in the order of (order column, position in the
text), computed without a global sort:

1. Documents are shuffled once by (side, file, block), a block being
   ``2**block_bits`` consecutive order values. Everything below reads that one
   exchange (line counts are taken from the shuffled text, so every branch needs
   the same columns and Spark reuses it): the text column is read once.
2. Inside a block a window numbers documents (at most ``2**block_bits`` of them);
   block totals are a hash aggregation over the same exchange.
3. Blocks form groups of ``2**level_bits`` consecutive blocks, and groups form groups
   in the same way up to the whole range of 64-bit values. Offsets come from windows
   inside these groups over narrow rows, so no window holds more than
   ``2**level_bits`` rows, however sparse the order values are.
4. Block offsets join back to the documents, which are already partitioned by
   block, so the text is not shuffled again; lines are split after that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bagdiff import schema as S


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _offsets(table: DataFrame, keys: list[str], order: str, size: str, name: str) -> DataFrame:
    """Running total of ``size`` over earlier ``order`` values within ``keys``."""
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return table.withColumn(name, F.coalesce(F.sum(size).over(earlier), F.lit(0)))


def _starts(table: DataFrame, sf: list[str], name: str, bits: int, level_bits: int) -> DataFrame:
    """``sf, name, _base``: the total ``_size`` of a file's rows with smaller ``name``,
    a value of ``bits`` bits, by way of groups of ``2**level_bits`` values."""
    if bits <= level_bits:
        return _offsets(table, sf, name, "_size", "_base").select(*sf, name, "_base")
    up = f"{name}_"
    inside = _offsets(table.withColumn(up, F.shiftright(name, level_bits)), [*sf, up], name, "_size", "_in")
    # the greatest end is the group's total, taken from the rows that the window has made
    groups = inside.groupBy(*sf, up).agg(F.max(F.col("_in") + F.col("_size")).alias("_size"))
    above = _starts(groups, sf, up, bits - level_bits, level_bits)
    return inside.join(above, [*sf, up]).select(*sf, name, (F.col("_base") + F.col("_in")).alias("_base"))


def bag_from_column(df: DataFrame, text: str | Column, side: str | Column, file: str | Column) -> DataFrame:
    """Lines without numbers as ``side, file, line``: nothing is shuffled. NULL texts have no lines."""
    text_c = _col(text)
    return df.where(text_c.isNotNull()).select(
        _col(side).alias("side"),
        F.coalesce(_col(file), F.lit("")).alias("file"),
        F.explode(F.split(text_c, "\n", -1)).alias("line"),
    )


def lines_from_column(
    df: DataFrame,
    text: str | Column,
    side: str | Column,
    file: str | Column,
    order: str | Column,
    block_bits: int = S.DOC_BLOCK_BITS,
    level_bits: int = S.DOC_LEVEL_BITS,
) -> DataFrame:
    """Split ``text`` on ``\\n`` into rows ``side, file, line_no, line``.

    ``order`` must be an integer column, unique within each (side, file); rows with
    NULL text or NULL order are skipped before numbering.
    """
    sf = ["side", "file"]
    # file is a join key below: a NULL name is the empty name (no line is lost)
    side_c, file_c = _col(side), F.coalesce(_col(file), F.lit(""))
    ord_c, text_c = _col(order).cast("long"), _col(text)
    # declared non-null, so joins on block ids infer no extra null filters
    blk_c = F.coalesce(F.shiftright(ord_c, block_bits), F.lit(0).cast("long"))
    # shuffle the source rows by expressions, name the columns afterwards: every
    # branch below then needs the same source columns at the exchange, which Spark
    # reuses, and the projection keeps the hash partitioning through its aliases
    docs = (
        df.where(text_c.isNotNull() & ord_c.isNotNull())
        .repartition(side_c, file_c, blk_c)
        .select(
            side_c.alias("side"),
            file_c.alias("file"),
            ord_c.alias("_ord"),
            text_c.alias("_text"),
            blk_c.alias("_blk"),
            # lines = number of "\n" + 1, counted after the shuffle (no array is built)
            (F.length(text_c) - F.length(F.replace(text_c, F.lit("\n"), F.lit(""))) + 1).alias("_n"),
        )
    )
    # block totals: a hash aggregation over the same exchange (no sort of the text)
    blocks = docs.groupBy(*sf, "_blk").agg(F.sum("_n").alias("_size"))
    docs = _offsets(docs, [*sf, "_blk"], "_ord", "_n", "_doff")
    starts = _starts(blocks, sf, "_blk", 64 - block_bits, level_bits)

    numbered = docs.join(starts, [*sf, "_blk"], "inner")
    return numbered.select(
        *sf,
        (F.col("_base") + F.col("_doff")).alias("_start"),
        F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "line"),
    ).select(
        *sf,
        (F.col("_start") + F.col("_pos") + F.lit(1)).cast("long").alias("line_no"),
        "line",
    )


def empty_occurrences(spark: SparkSession) -> DataFrame:
    """An empty occurrence DataFrame, the identity of ``unionByName``."""
    return spark.createDataFrame([], S.OCCURRENCE)
