"""A side kept by key, to be compared many times.

:func:`store_side` writes the lines of one side, with their keys, as a table bucketed by key: that is
the side's one exchange. :func:`compare_stored` compares another side with it: the stored
lines are read bucket by bucket and stay where they are, only the other side's lines move, to as
many partitions, and the windows of the comparison run on the union of both.

Lines of heavy keys would fill one bucket, so they are written to a second table
(``<table>_heavy``) that is not bucketed. They, and lines of keys that are heavy on the other
side, are compared the usual way, in parts (see ``operators.classify``); the rest never meets them.

The flags that made the keys are properties of the table. A comparison uses these flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bagdiff import schema as S
from bagdiff.operators.classify import bucket_of, heavy_keys, rank_occurrences, rank_windows
from bagdiff.operators.partition import repartition_by_key
from bagdiff.plans.pipelines import FILES, POOLED, keep_needle, named, rank_args, with_key

_COLUMNS = ["side", "file", "line_no", "line", "key"]
_FLAGS = ("space_sensitive", "case_sensitive")


def _hash() -> Column:
    return F.xxhash64("key")


def _tagged(rows: DataFrame, hashes: list[int]) -> DataFrame:
    """Rows with ``_hot``: whether their key's hash is one of ``hashes``."""
    hot = rows.sparkSession.createDataFrame([(h, True) for h in hashes], "_h long, _hot boolean")
    return rows.withColumn("_h", _hash()).join(F.broadcast(hot), "_h", "left").drop("_h")


def _split(rows: DataFrame, hashes: list[int]) -> tuple[DataFrame, DataFrame | None]:
    """Rows without and with the keys of ``hashes``."""
    if not hashes:
        return rows, None
    both = _tagged(rows, hashes)
    return both.where(F.col("_hot").isNull()).drop("_hot"), both.where(F.col("_hot")).drop("_hot")


def store_side(
    occ: DataFrame,
    table: str,
    buckets: int,
    space_sensitive: bool = False,
    case_sensitive: bool = False,
    heavy_rows: int | None = S.HEAVY_ROWS,
    probe: DataFrame | None = None,
    path: str | None = None,
) -> None:
    """Write the lines of one side (``side, file, line_no, line``) as ``table``, in ``buckets`` buckets by key.

    Choose ``buckets`` for about 256 MB of lines each. ``path`` is the folder of the
    tables' files where they should not be in the warehouse. ``probe`` as in :func:`compare`. NULL lines are skipped.
    """
    flags = (space_sensitive, case_sensitive)

    def keyed(rows: DataFrame) -> DataFrame:
        return with_key(named(rows).where(F.col("line").isNotNull()), *flags)

    rows = keyed(occ).select(*_COLUMNS)
    hashes = [] if heavy_rows is None else heavy_keys(rows if probe is None else keyed(probe), [F.col("key")], heavy_rows)
    light, heavy = _split(rows, hashes)

    def write(writer, name: str) -> None:
        if path:
            writer = writer.option("path", f"{path.rstrip('/')}/{name.rsplit('.', 1)[-1]}")
        writer.format("parquet").saveAsTable(name)

    write(repartition_by_key(light, buckets).write.bucketBy(buckets, "key").sortBy("key"), table)
    write((rows.limit(0) if heavy is None else heavy).write, f"{table}_heavy")
    kept = ", ".join(f"'bagdiff.{k}' = '{str(v).lower()}'" for k, v in zip(("buckets", *_FLAGS), (buckets, *flags), strict=True))
    occ.sparkSession.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({kept})")


def compare_stored(
    spark: SparkSession,
    table: str,
    other: DataFrame,
    mode: str = FILES,
    needle: str | None = "",
    heavy_rows: int | None = S.HEAVY_ROWS,
    chunk_bits: int = S.CHUNK_BITS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """E1 (``FILES``) or E3 (``POOLED``): the stored side and ``other`` (``side, file, line_no, line``).

    The result is that of :func:`compare` on both; ``probe`` are the lines of ``other`` without numbers.
    """
    if mode not in (FILES, POOLED):
        raise ValueError("a stored side is compared as FILES or POOLED")
    kept = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    buckets, flags = int(kept["bagdiff.buckets"]), [kept[f"bagdiff.{k}"] == "true" for k in _FLAGS]

    def keyed(rows: DataFrame) -> DataFrame:
        return keep_needle(with_key(named(rows).where(F.col("line").isNotNull()), *flags), needle)

    rows = keyed(other).select(*_COLUMNS)
    stored, stored_heavy = (keep_needle(spark.table(t), needle) for t in (table, f"{table}_heavy"))
    hashes = [r[0] for r in stored_heavy.select(_hash()).distinct().collect()]  # at most two for heavy_rows stored lines
    if heavy_rows is not None:
        hashes = list({*hashes, *heavy_keys(rows if probe is None else keyed(probe), [F.col("key")], heavy_rows)})
    order = rank_args(mode)["order"]
    light, heavy = _split(rows, hashes)
    stored_light, moved = _split(stored, hashes)
    out = rank_windows(stored_light.unionByName(repartition_by_key(light, buckets)), ["key"], order)
    if hashes:
        hot = heavy.unionByName(moved).unionByName(stored_heavy)
        out = out.unionByName(rank_occurrences(hot, (), order, 0, chunk_bits, hashes=hashes))
    return out.withColumn("bucket", bucket_of())
