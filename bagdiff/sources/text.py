"""Text-file scans with exact per-file line numbers.

``spark.read.text`` splits files into blocks, so a row does not know its line
number. Each row gets ``monotonically_increasing_id`` (consecutive inside a
block), the block it came from, and a sub-block: the rows of a block with the same id
``>> LINE_BLOCK_BITS``. So a file that cannot be split (gzip) is one block, but many sub-blocks. The
rows are exchanged once by (side, file, block, sub-block); sizes and first row ids are
counted from that same exchange, a window over each file's sub-blocks turns sizes into offsets,
and these join back to rows that are already where they are needed. So the files are read once, no task
of the exchange holds more of a file than a few sub-blocks, and numbers do not
depend on how blocks were packed into tasks. Nothing runs before an action.

UTF-16 and UTF-32 of a named byte order are cut at the bytes of their line feed, wherever these stand. Such a cut is
a line's end only if it is aligned to the charset's units, as other characters may hold the same
bytes across two units, and text may hold many of these. So pieces are not exchanged: a first scan measures each block
(its bytes, and its aligned cuts for each offset that it may have), windows over these narrow rows give every block its
offset and first line number, and in a second scan each task joins the pieces of its lines in the scan's own
order. Only the pieces of lines that reach over a block's border meet in an exchange, by a third scan that
drops all others. A file that cannot be split is numbered and joined by the task that reads it, which holds one line at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bagdiff import schema as S
from bagdiff.functions.paths import clean_path
from bagdiff.sources import wide

# Charsets whose newline is not the single byte 0x0A, by their bytes a unit.
_WIDE_CHARSETS = {"UTF-16BE": 2, "UTF-16LE": 2, "UTF-32BE": 4, "UTF-32LE": 4}
_NO_BYTE_ORDER = ("UTF-16", "UTF-32")
_BLOCK = ["side", "_f", "_b", "_s"]


def _normal(encoding: str) -> str:
    return encoding.upper().replace("_", "-")


def _line_feed(encoding: str) -> str:
    """The bytes of a wide charset's line feed, as characters."""
    zeros = "\0" * (_WIDE_CHARSETS[encoding] - 1)
    return "\n" + zeros if encoding.endswith("LE") else zeros + "\n"


def scan_text(
    spark: SparkSession,
    paths: str | Sequence[str],
    recursive: bool = True,
    line_bits: int = S.LINE_BLOCK_BITS,
    line_sep: str | None = None,
) -> DataFrame:
    """Raw scan: ``_f`` file URI, ``_b`` block start, ``_s`` sub-block, ``_m`` row id, ``_raw`` line."""
    reader = spark.read.format("text").option("recursiveFileLookup", str(recursive).lower())
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    raw = reader.load([paths] if isinstance(paths, str) else list(paths))
    return raw.select(
        F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"),
        F.monotonically_increasing_id().alias("_m"),
        F.coalesce(F.col("value"), F.lit("")).alias("_raw"),
    ).withColumn("_s", F.shiftright("_m", line_bits))


def decode_line(raw, encoding: str = "UTF-8"):
    """Line text in ``encoding``; UTF-8 needs no decoding (the bytes are kept as read)."""
    if _normal(encoding) in ("UTF-8", "UTF8"):
        return raw
    return F.decode(raw.cast("binary"), encoding)


# Charsets Spark's decode() accepts without the Java-charset setting.
_SPARK_CHARSETS = ("US-ASCII", "ISO-8859-1", "UTF-8", "UTF8", "UTF-16BE", "UTF-16LE")


def _check_charset(spark: SparkSession, encoding: str) -> None:
    enc = _normal(encoding)
    if enc in _NO_BYTE_ORDER:
        raise ValueError(f"{encoding} does not say the order of its bytes: use {encoding}LE or {encoding}BE")
    if enc not in _SPARK_CHARSETS and spark.conf.get("spark.sql.legacy.javaCharsets", "false").lower() != "true":
        raise ValueError(
            f"charset {encoding} needs spark.sql.legacy.javaCharsets=true "
            "(call bagdiff.session.enable_java_charsets(spark) or set it at session start)"
        )


def _both(spark, sides, recursive, line_bits=S.LINE_BLOCK_BITS) -> DataFrame:
    scan = None
    for side, paths in sides.items():
        own = scan_text(spark, paths, recursive, line_bits).withColumn("side", F.lit(side))
        scan = own if scan is None else scan.unionByName(own)
    return scan


def read_sides(
    spark: SparkSession,
    sides: dict[str, str | Sequence[str]],
    encoding: str = "UTF-8",
    recursive: bool = True,
    line_bits: int = S.LINE_BLOCK_BITS,
) -> DataFrame:
    """Lines of text files as ``side, file, line_no, line`` with 1-based line
    numbers per file; ``file`` is the decoded path. ``sides`` maps a side name to
    its paths; a file compared with itself is numbered once per side.

    In UTF-16 and UTF-32 lines end with a line feed, or carriage return and line feed; a byte order mark is no text."""
    _check_charset(spark, encoding)
    if _normal(encoding) in _WIDE_CHARSETS:
        return _wide_lines(spark, sides, _normal(encoding), recursive)
    rows = _both(spark, sides, recursive, line_bits).repartition(*_BLOCK)
    # block sizes are taken from all columns that the rows need, so both branches share the exchange
    blocks = rows.groupBy(*_BLOCK).agg(F.count_if(F.length("_raw") >= 0).alias("_n"), F.min("_m").alias("_m0"))
    before = Window.partitionBy("side", "_f").orderBy("_b", "_s").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(*_BLOCK, (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1 - F.col("_m0")).alias("_start"))
    # a line belongs to its numbered block: so no later filter on lines is moved below the
    # exchange, where it would change what is counted
    line = F.when(F.col("_start").isNotNull(), decode_line(F.col("_raw"), encoding))
    return rows.join(starts, _BLOCK).select(
        "side",
        clean_path("_f").alias("file"),
        (F.col("_start") + F.col("_m")).cast("long").alias("line_no"),
        line.alias("line"),
    )


def _wide_lines(spark, sides, encoding, recursive) -> DataFrame:
    """:func:`read_sides` for a wide charset."""
    lines = None
    for side, paths in sides.items():
        own = _wide_side(spark, paths, encoding, recursive).withColumn("side", F.lit(side))
        lines = own if lines is None else lines.unionByName(own)
    text = F.regexp_replace(decode_line(F.col("_raw"), encoding), "\r\\z", "")
    text = F.when(F.col("line_no") == 1, F.regexp_replace(text, "\\A\ufeff", "")).otherwise(text)
    return lines.select("side", clean_path("_f").alias("file"), "line_no", text.alias("line"))


def _wide_side(spark, paths, encoding, recursive) -> DataFrame:
    """``_f, line_no, _raw`` of a side's lines in a wide charset, without their line feeds."""
    unit, line_sep = _WIDE_CHARSETS[encoding], _line_feed(encoding)
    rows = scan_text(spark, paths, recursive, line_sep=line_sep).drop("_s")
    # the cuts' own bytes are whole units, so lengths without them tell whether a cut is aligned
    sizes = rows.select("_f", "_b", "_m", F.octet_length("_raw").cast("long").alias("_size"))
    blocks = sizes.mapInArrow(wide.measured(unit), wide.MEASURED)
    before = Window.partitionBy("_f").orderBy("_b", "_m0").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_offset", (F.coalesce(F.sum("_size").over(before), F.lit(0)) % unit).cast("int"))
    blocks = blocks.withColumns({c: F.get(c, F.col("_offset")) for c in ("_n", "_first", "_last")})
    blocks = blocks.withColumn("_line", F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1)
    # whole lines are in the rows after the first aligned cut, or from the block's start if a line starts there, up to the last
    since = F.when(F.col("_offset") == 0, F.col("_m0")).otherwise(F.col("_first") + 1)
    starts = blocks.select(
        F.col("_f").alias("_sf"),
        F.col("_b").alias("_sb"),
        "_m0",
        "_m1",
        F.when(F.col("_n") > 0, since).otherwise(F.col("_m1") + 1).alias("_since"),
        F.coalesce("_last", F.col("_m0") - 1).alias("_until"),
        "_line",
        (F.col("_line") + F.col("_n")).alias("_after"),
    )
    # a row for each block, so tasks can hold all; a row keeps its place in the scan
    own = (F.col("_f") == F.col("_sf")) & (F.col("_b") == F.col("_sb")) & F.col("_m").between(F.col("_m0"), F.col("_m1"))
    inside = F.col("_m").between(F.col("_since"), F.col("_until"))
    feed = F.lit(line_sep.encode("latin-1"))
    whole = rows.join(F.broadcast(starts), own).where(inside).select(
        "_f",
        "_m0",
        (F.col("_line") + (F.col("_since") > F.col("_m0")).cast("int")).alias("_line"),
        "_after",
        F.concat(F.col("_raw").cast("binary"), feed).alias("_raw"),
    )
    whole = whole.mapInArrow(wide.joined(unit), wide.JOINED)
    whole = whole.withColumn("_raw", F.substring("_raw", F.lit(1), F.octet_length("_raw") - unit))
    # lines that go on in other blocks, and an end that is no whole unit
    line_no = F.when(F.col("_m") < F.col("_since"), F.col("_line")).when(F.col("_m") > F.col("_until"), F.col("_after"))
    changed = F.raise_error(F.lit("the scan's blocks are others than when they were measured")).cast("long")
    line_no = F.when(F.col("_m0").isNull(), changed).otherwise(line_no)
    cut = rows.join(F.broadcast(starts), own, "left").where(F.col("_m0").isNull() | ~inside)
    pieces = F.transform(F.sort_array(F.collect_list(F.struct("_b", "_m", "_raw"))), lambda x: x["_raw"])
    cut = cut.groupBy("_f", line_no.alias("line_no")).agg(F.array_join(pieces, line_sep).cast("binary").alias("_raw"))
    return whole.unionByName(cut)


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    side: str,
    encoding: str = "UTF-8",
    recursive: bool = True,
) -> DataFrame:
    """Lines of the text files under ``paths`` for one side (see :func:`read_sides`)."""
    return read_sides(spark, {side: paths}, encoding, recursive)


def read_bag(
    spark: SparkSession,
    sides: dict[str, str | Sequence[str]],
    encoding: str = "UTF-8",
    recursive: bool = True,
) -> DataFrame:
    """Lines without numbers as ``side, file, line``: a plain scan, nothing is exchanged (but in UTF-16 and UTF-32)."""
    _check_charset(spark, encoding)
    if _normal(encoding) in _WIDE_CHARSETS:
        return read_sides(spark, sides, encoding, recursive).drop("line_no")
    raw = _both(spark, sides, recursive)
    return raw.select("side", clean_path("_f").alias("file"), decode_line(F.col("_raw"), encoding).alias("line"))
