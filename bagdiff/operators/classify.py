"""Multiset comparison of two sides.

For every group ``by + key`` with ``n_left`` left and ``n_right`` right
occurrences, the occurrences of a side are ranked latest first (``occ_rank`` 1 is
the last line); ranks ``1..least(n_left, n_right)`` are common, the rest differ.
That single rule covers the one-sided keys, both surplus cases and equal counts.

The lines of a key meet in one exchange and get counts and ranks from windows there.
A key with over ``heavy_rows`` lines would make one task too large. Whether there are such
keys is found before the plan is built: one narrow pass without an exchange of lines draws lines at a
rate that gives ``HEAVY_DRAWS`` of a key with ``heavy_rows`` lines, and counts them by a 64-bit hash of their key.
What moves is a fixed share of the lines (one in 8,192 by default), however many keys there
are, and a hash with over half of the expected draws is heavy, so there are at most two for each
``heavy_rows`` lines of the input and no cap is needed. A heavy key is overlooked once in some 10^8; ranks do not
depend on it, as both ways give the same.

Without heavy keys the plan is the plain one. With some, their lines are dealt to parts of
their own in that same exchange: ``2**chunk_bits`` consecutive lines of a file and side. Parts
are counted where they are, a window over these counts gives a key's totals and the occurrences
in later parts, and both are joined to the ranks inside the parts. Other keys have one part and need none of
this: their lines fold into one row for each task before anything is counted. A key that
merely shares a heavy key's hash is dealt to parts too, with the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bagdiff import schema as S


def key_counts(occ: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by..., key, n_left, n_right``: partial + final hash aggregation."""
    return occ.groupBy(*by, "key").agg(
        F.count_if(F.col("side") == S.LEFT).cast("long").alias("n_left"),
        F.count_if(F.col("side") == S.RIGHT).cast("long").alias("n_right"),
    )


def bag_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both sides as one bag (UNION ALL by column name)."""
    return left.unionByName(right, allowMissingColumns=True)


def heavy_keys(lines: DataFrame, keys: Sequence[Column], heavy_rows: int) -> list[int]:
    """Hashes of the keys with over ``heavy_rows`` lines (runs a job over ``lines``).

    Up to ``HEAVY_DRAWS`` rows every line is counted, and the hashes are exact.
    """
    bits = max(0, heavy_rows.bit_length() - S.HEAVY_DRAWS.bit_length())
    drawn = lines.where(F.rand(S.HEAVY_SEED) < 1 / (1 << bits)) if bits else lines
    counts = drawn.groupBy(F.xxhash64(*keys).alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    enough = heavy_rows >> (bits + 1) if bits else heavy_rows
    return [r[0] for r in counts.where(F.col("_n") > enough).select("_h").collect()]


def rank_windows(rows: DataFrame, whole: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` plus ``occ_rank, n_left, n_right`` inside each group of ``whole``, by windows."""
    latest_first = Window.partitionBy(*whole, "side").orderBy(*[F.desc(c) for c in order])
    ranked = rows.withColumn("occ_rank", F.row_number().over(latest_first).cast("long"))
    counts = {
        f"n_{side}": F.count_if(F.col("side") == side).over(Window.partitionBy(*whole)).cast("long")
        for side in (S.LEFT, S.RIGHT)
    }
    return ranked.withColumns(counts)


def rank_occurrences(
    occ: DataFrame,
    by: Sequence[str] = (),
    order: Sequence[str] = ("line_no",),
    heavy_rows: int | None = S.HEAVY_ROWS,
    chunk_bits: int = S.CHUNK_BITS,
    key_of: Callable[[Column], Column] | None = None,
    probe: DataFrame | None = None,
    hashes: list[int] | None = None,
) -> DataFrame:
    """Occurrences plus ``n_left, n_right, occ_rank``.

    Rank 1 is the occurrence that comes last in ``order`` within its
    ``by + key + side``. With ``key_of`` (the function that made ``key`` from
    ``line``) lines move without their key. Heavy keys are looked for in ``probe``, rows with the
    columns that keys are made of; lines without numbers will do, and cost less than ``occ``, which is read if there is none.
    ``heavy_rows=None`` treats no key as heavy and looks for none; ``hashes`` are heavy keys that are known.
    """
    keys, names = [*by, "key"], occ.columns
    prefix, last = [c for c in order[:-1] if c not in by], order[-1]
    made = [key_of(F.col("line")) if c == "key" and key_of else F.col(c) for c in keys]
    moved = occ.drop("key") if key_of else occ

    def met(rows: DataFrame, *more: Column) -> DataFrame:
        out = rows.repartition(*made, *more)
        return out.withColumn("key", key_of(F.col("line"))) if key_of else out

    heavy = hashes
    if heavy is None:
        heavy = [] if heavy_rows is None else heavy_keys(occ if probe is None else probe, made, heavy_rows)
    if not heavy:
        return rank_windows(met(moved), keys, order).select(*names, "n_left", "n_right", "occ_rank")

    hot = occ.sparkSession.createDataFrame([(h, True) for h in heavy], "_h long, _hot boolean")
    tagged = occ.withColumn("_h", F.xxhash64(*keys)).join(F.broadcast(hot), "_h", "left").select(*moved.columns, "_hot")
    # a part names its lines' side, file and chunk, so it holds at most 2^chunk_bits lines
    part = F.when(F.col("_hot"), F.struct("side", *prefix, F.shiftright(F.col(last), chunk_bits).alias("_chunk")))
    dealt = met(tagged, part).withColumn("_part", part)
    # counted where the lines are; all lines of other keys are one row of a task
    parts = dealt.groupBy(*[F.when(F.col("_hot"), F.col(c)).alias(c) for c in keys], F.col("_part")).agg(F.count(F.lit(1)).alias("_n"))
    parts = parts.where(F.col("_part").isNotNull())
    # left parts first, latest first; a right part's running total includes every left line, which is subtracted
    part_order = [F.desc(f"_part.{c}") for c in [*prefix, "_chunk"]]
    spec = Window.partitionBy(*keys).orderBy(F.col("_part.side") != S.LEFT, *part_order)
    everything = spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = spec.rowsBetween(Window.unboundedPreceding, -1)

    def total(side: str) -> Column:
        own = F.when(F.col("_part.side") == side, F.col("_n")).otherwise(F.lit(0))
        return F.sum(own).over(everything).cast("long")

    running = F.coalesce(F.sum("_n").over(earlier), F.lit(0)).cast("long")
    before = running - F.when(F.col("_part.side") == S.RIGHT, total(S.LEFT)).otherwise(F.lit(0))
    parts = parts.select(
        *keys, "_part", total(S.LEFT).alias("_left"), total(S.RIGHT).alias("_right"), before.alias("_before")
    )
    return (
        rank_windows(dealt, [*keys, "_part"], order)
        .join(parts, [*keys, "_part"], "left")
        .select(
            *names,
            F.coalesce("_left", "n_left").alias("n_left"),
            F.coalesce("_right", "n_right").alias("n_right"),
            (F.coalesce("_before", F.lit(0)) + F.col("occ_rank")).cast("long").alias("occ_rank"),
        )
    )


def bucket_of(occ_rank="occ_rank", n_left="n_left", n_right="n_right", side="side"):
    """``comm_<side>`` for ranks up to ``least(n_left, n_right)``, else ``diff_<side>``."""
    common = F.col(occ_rank) <= F.least(F.col(n_left), F.col(n_right))
    return F.concat(F.when(common, F.lit("comm_")).otherwise(F.lit("diff_")), F.col(side))


def classify(
    occ: DataFrame,
    by: Sequence[str] = (),
    order: Sequence[str] = ("line_no",),
    heavy_rows: int | None = S.HEAVY_ROWS,
    chunk_bits: int = S.CHUNK_BITS,
    key_of: Callable[[Column], Column] | None = None,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Occurrences plus ``n_left, n_right, occ_rank, bucket``.

    ``by``: extra grouping columns (``("file",)`` compares file pairs in one job).
    ``order``: rank order, latest first; ``("file", "line_no")`` for pooled input.
    """
    return rank_occurrences(occ, by, order, heavy_rows, chunk_bits, key_of, probe).withColumn("bucket", bucket_of())


def bucket_view(classified: DataFrame, bucket: str) -> DataFrame:
    """One of the four buckets (U2/U3 seen from one side)."""
    if bucket not in S.BUCKETS:
        raise ValueError(f"bucket must be one of {S.BUCKETS}")
    return classified.where(F.col("bucket") == bucket)


def replicate(counts: DataFrame, n: str, cols: Sequence[str], chunk_bits: int = S.CHUNK_BITS) -> DataFrame:
    """``n`` copies of each row of ``cols``, generated in chunks of ``2**chunk_bits``
    spread over tasks by a shuffle on (cols, chunk), so a key with a huge count is
    not generated by one task."""
    size = 1 << chunk_bits
    cols = list(cols)
    chunks = counts.where(F.col(n) > 0).select(
        *cols,
        F.col(n).alias("_n"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col(n) - F.lit(1), chunk_bits))).alias("_c"),
    )
    spread = chunks.repartition(*cols, "_c")
    in_chunk = F.least(F.col("_n") - F.col("_c") * F.lit(size), F.lit(size))
    return spread.select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), in_chunk)).alias("_i")).select(*cols)


def intersect_all_keys(bag: DataFrame, chunk_bits: int = S.CHUNK_BITS) -> DataFrame:
    """Keys common to both sides of a bag (``side, key``), with multiplicity
    (INTERSECT ALL): each ``least(n_left, n_right)`` times. Both sides are counted in
    one partial aggregation; the copies are generated by :func:`replicate`."""
    counts = key_counts(bag).withColumn("_m", F.least("n_left", "n_right"))
    return replicate(counts, "_m", ["key"], chunk_bits)


def except_all_keys(bag: DataFrame, chunk_bits: int = S.CHUNK_BITS) -> DataFrame:
    """Left keys of a bag (``side, key``) not matched on the right, with multiplicity
    (EXCEPT ALL): each ``n_left - n_right`` times when positive."""
    counts = key_counts(bag).withColumn("_m", F.col("n_left") - F.col("n_right"))
    return replicate(counts, "_m", ["key"], chunk_bits)
