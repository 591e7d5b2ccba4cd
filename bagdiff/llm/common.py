"""Helpers shared by the operators: bounded text chunks, written tables, skew-safe joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bagdiff.session import scratch_path

#: Characters that a task holds at once in expanded (numpy) form.
CHUNK_CHARS = 1_000_000
#: Bytes of an Arrow batch between Spark and Python: executors hold a few of them outside their heap.
BATCH_BYTES = 8 << 20
#: A key is heavy when it holds more than 1/HEAVY_SHARE of all rows, so at most HEAVY_SHARE keys are.
HEAVY_SHARE = 512

_scopes: list[list[str]] = []


def materialize(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage with files that every executor sees, so a lost executor
    costs only its running tasks. The folder is fresh for each call. ``narrow`` rows
    that come straight from a shuffle are written by a few tasks per core at most, not by
    one per shuffle partition: many small files cost more than they hold.
    """
    spark = df.sparkSession
    if narrow:
        df = df.coalesce(4 * spark.sparkContext.defaultParallelism)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    for paths in _scopes:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def written() -> Iterator[list[str]]:
    """The folders that :func:`materialize` writes inside the block, in order."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield paths
    finally:
        _scopes[:] = [x for x in _scopes if x is not paths]


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete written tables that nothing reads any more, wherever the shared folder lies."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def chunks(texts, max_chars: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) slices of an Arrow string array of about ``max_chars`` characters; null reads as empty.

    A single longer text forms a slice of its own.
    """
    first, held, size = 0, [], 0
    for start in range(0, len(texts), 256):
        for text in texts.slice(start, 256).to_pylist():
            text = text or ""
            if held and size + len(text) > max_chars:
                yield first, held
                first, held, size = first + len(held), [], 0
            held.append(text)
            size += len(text)
    if held:
        yield first, held


def one_each(df: DataFrame, by: list[str]) -> DataFrame:
    """One row of ``df`` for each value of ``by`` (null is one), with all its columns: that of the smallest hash.

    Tasks combine their own rows first, so no task receives more than one row of a value from each.
    """
    hashed = [F.col(c) for c, kind in df.dtypes if "map<" not in kind]  # maps have no hash
    row = F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.xxhash64(*hashed))
    return df.groupBy(*by).agg(row.alias("__row")).select("__row.*")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def attach_by_key(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left join ``groups`` (one row per non-null ``key``, with its number of rows ``size``) to ``rows``.

    Keys with over ``total / HEAVY_SHARE`` rows, at most ``HEAVY_SHARE`` of them, are
    broadcast; their rows take a key of their own in the shuffled join, so no task
    receives a hot key. Returns the columns of ``rows`` and those of ``groups``.
    """
    values = [c for c in groups.columns if c != key]
    heavy = groups.filter(F.col(size) > max(1000, total // HEAVY_SHARE))
    heavy = heavy.select(F.col(key).alias("__k"), F.struct(*values).alias("__heavy"))
    light = groups.select(F.struct(F.col(key)).alias("__key"), F.struct(*values).alias("__light"))
    spread = F.when(F.col("__heavy").isNull(), F.struct(F.col(key)))
    out = (
        rows.join(F.broadcast(heavy), F.col(key).eqNullSafe(F.col("__k")), "left")
        .withColumn("__key", spread)
        .withColumn("__spread", F.when(F.col("__key").isNull(), F.xxhash64(*rows.columns)).otherwise(F.lit(0)))
        .join(light.withColumn("__spread", F.lit(0).cast("bigint")), ["__key", "__spread"], "left")
    )
    return out.select(
        *rows.columns,
        *[F.coalesce(F.col(f"__heavy.{v}"), F.col(f"__light.{v}")).alias(v) for v in values],
    )


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session hold ``BATCH_BYTES`` at most, as the operators' memory bounds assume."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int("".join(filter(str.isdigit, spark.conf.get(key)))) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def give_back() -> None:
    """Give memory that this process has freed back to the system."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """``run``, an iterator function of a task, giving freed memory back to the system when it ends.

    Python workers wait for the next task with what they hold, and executors count it.
    """

    def tidied(batches):
        yield from run(batches)
        give_back()

    return tidied


def arrow_column(run: Callable, returns: str, column: Column) -> Column:
    """Column of a function from an iterator of Arrow arrays to one of Arrow arrays, as many values in all."""
    import pyarrow as pa

    bound_batches(SparkSession.active())
    run = tidy(run)
    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, returns)(column)
