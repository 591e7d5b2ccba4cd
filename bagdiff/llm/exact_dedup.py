"""Exact deduplication with skew-safe combining, in DataFrame operations alone.

Texts are equal when they are identical after each run of space, tab, line feed,
vertical tab, form feed and carriage return is replaced by one space; null counts
as empty. Three combining stages group by the digest *and the full text*:

1. each task combines its own equal texts of a salt (Spark's partial aggregation);
2. the rows of one (digest, text, salt) meet in one task;
3. the winners of the salts, at most ``salts`` rows for a text, meet in one task.

A group of copies, however large, is cut by salt and reduced before each shuffle.
Documents find their group by digest alone where the digest has one text, which
the stages have established by comparing texts; a digest of several texts (a
collision) is resolved by joining on the text too.

Defined results: the smallest id of a group stays; rows that repeat this id are
the same document and all stay. Null ids lose to any other; a group with null ids
alone keeps them. Other columns are ignored; ``kept_rows`` returns them unchanged, and
``one_of_each`` returns one row of each group, also where rows share an id or have none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagdiff.llm.common import attach_by_key, materialize, one_each

SALTS = 64


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def group_copies(
    df: DataFrame, id: str = "doc_id", text: str = "text", salts: int = SALTS, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """One row per row of ``df``: ``id``, digest (binary), keep_id, group_size, kept."""
    texts = df.select(F.col(id).alias("id"), normalized(F.col(text)).alias("norm"))
    texts = texts.withColumn("digest", digest(F.col("norm")))
    salted = (
        texts.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
        .groupBy("digest", "norm", "salt")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    )
    whole = salted.groupBy("digest", "norm").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    by_digest = whole.groupBy("digest").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count(F.lit(1)).alias("texts")
    )
    groups = materialize(by_digest, "dedup-groups", narrow=True)
    total, most = groups.agg(F.sum("group_size"), F.max("texts")).first()
    rows = texts.select("id", "digest")
    found = attach_by_key(rows, groups, "digest", "group_size", total or 0)
    if (most or 0) > 1:
        clash = groups.filter("texts > 1").select("digest")
        inside = texts.join(clash, "digest", "left_semi").join(
            whole.join(clash, "digest", "left_semi"), ["digest", "norm"]
        )
        found = found.filter("texts = 1").drop("texts").unionByName(inside.drop("norm"))
    return found.select(
        F.col("id").alias(id), "digest", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept")
    )


def kept_rows(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all its columns; rows that repeat an id with the same text all stay."""
    groups = group_copies(df, id, text).filter("kept")
    keys = groups.groupBy(F.col(id).alias("__id"), F.col("digest").alias("__digest")).agg(F.count(F.lit(1)).alias("__n"))
    tagged = df.withColumn("__d", sha256(normalized(F.col(text))))
    on = F.col(id).eqNullSafe(F.col("__id")) & (F.col("__d") == F.col("__digest"))
    return tagged.join(keys, on, "left_semi").drop("__d")


def one_of_each(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Exactly one row of ``df`` for each group, with all its columns: one with the group's smallest id.

    The ids that go are written and taken out of ``df`` by an anti-join: while they are few, Spark
    broadcasts them by their size in files and no text moves. Texts move together only for ids
    that several rows share, which are told apart by their digests.
    """
    groups = group_copies(df, id, text).select(F.col(id).alias("__id"), F.col("digest").alias("__digest"), "kept")
    ids = groups.groupBy("__id").agg(F.count(F.lit(1)).alias("__n"), F.max("kept").alias("__kept"))
    gone = materialize(ids.filter("__n > 1 or not __kept"), "dedup-gone", narrow=True)
    same = F.col(id).eqNullSafe(F.col("__id"))
    out = df.join(gone, same, "left_anti")
    repeated = gone.filter("__n > 1 and __kept")
    if repeated.isEmpty():
        return out
    shared = repeated.select(F.col("__id").alias("__any"))
    keys = groups.filter("kept").join(shared, F.col("__id").eqNullSafe(F.col("__any")), "left_semi")
    keys = materialize(keys.select("__id", "__digest").distinct(), "dedup-shared", narrow=True)
    rows = df.join(repeated, same, "left_semi").withColumn("__d", sha256(normalized(F.col(text))))
    rows = rows.join(keys, same & (F.col("__d") == F.col("__digest")), "left_semi")
    return out.unionByName(one_each(rows, [id, "__d"]).drop("__d"))
