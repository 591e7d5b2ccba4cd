from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from bagdiff.llm.common import attach_by_key, chunks, materialize


def test_chunks_are_whole_and_bounded():
    texts = ["a" * n for n in (0, 5, 30, 3, 3, 3)] + [None]
    got = list(chunks(pa.array(texts), 10))
    assert [t for _, part in got for t in part] == [t or "" for t in texts]
    assert [first for first, _ in got] == [sum(len(p) for _, p in got[:i]) for i in range(len(got))]
    assert all(len(p) == 1 or sum(map(len, p)) <= 10 for _, p in got)


def test_attach_by_key_with_heavy_light_missing_and_null_keys(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("r"), F.when(F.col("id") < 4000, F.lit("hot")).when(F.col("id") < 4900, (F.col("id") % 50).cast("string")).alias("k")
    )
    groups = rows.filter("k is not null and k <> '7'").groupBy("k").agg(F.count("*").alias("n"), F.min("r").alias("least"))
    got = {r.r: (r.k, r.n, r.least) for r in attach_by_key(rows, groups, "k", "n", 5000).collect()}
    by = {}
    for r in rows.collect():
        by.setdefault(r.k, []).append(r.r)
    want = {}
    for k, own in by.items():
        known = k is not None and k != "7"
        want |= {r: (k, len(own) if known else None, min(own) if known else None) for r in own}
    assert got == want


def test_materialized_tables_lie_in_the_shared_folder(spark):
    df = materialize(spark.range(3), "probe")
    assert df.count() == 3
    assert spark.sparkContext.getCheckpointDir().rsplit("/", 1)[0].replace("file:", "") in df.inputFiles()[0]
