"""A key holding a third of all lines, ranked in many small chunks."""

import random

from conftest import bucket_rows, emulate
from pyspark.sql import functions as F

from bagdiff import compare, render
from bagdiff.plans.pipelines import FILES, POOLED


def test_hot_key_in_small_chunks(spark):
    rng = random.Random(3)
    n = 3000
    left = ["" if rng.random() < 0.34 else f"v{rng.randint(0, 300)}" for _ in range(n)]
    right = ["" if rng.random() < 0.30 else f"V {rng.randint(0, 300)}" for _ in range(n)]
    rows = [("left", "l.txt", i + 1, x) for i, x in enumerate(left)] + [("right", "r.txt", i + 1, x) for i, x in enumerate(right)]
    occ = spark.createDataFrame(rows, "side string, file string, line_no long, line string")
    res = compare(occ, FILES, heavy_rows=100, chunk_bits=5)
    got = {(r.side, r.line_no): r.bucket for r in res.select("side", "line_no", "bucket").collect()}
    assert got == emulate(left, right)[0]
    # the blank key spans many chunks; its ranks are still 1..n per side
    blank = res.where(F.col("key") == "").groupBy("side").agg(F.min("occ_rank"), F.max("occ_rank"), F.count(F.lit(1))).collect()
    for r in blank:
        assert r[1] == 1 and r[2] == r[3]


def test_hot_group_is_one_row(spark):
    rows = [("left", "l.txt", i + 1, "x") for i in range(50)] + [("right", "r.txt", i + 1, "x") for i in range(3)]
    occ = spark.createDataFrame(rows, "side string, file string, line_no long, line string")
    for heavy_rows in (10, None):
        got = bucket_rows(render(compare(occ, FILES, heavy_rows=heavy_rows, chunk_bits=3)))
        assert got["diff_left"] == ["[" + ", ".join(f"{i}:x" for i in range(47, 0, -1)) + "]"]


def test_one_key_in_many_files(spark):
    """A key in 5,000 files, pooled: its ranks follow (file, line) from the last, whichever way it takes."""
    occ = spark.range(15_000).select(
        F.when(F.col("id") % 5 == 0, "right").otherwise("left").alias("side"),
        F.format_string("f%05d", (F.col("id") / 3).cast("int")).alias("file"),
        (F.col("id") % 3 + 1).alias("line_no"),
        F.lit("").alias("line"),
    )
    for heavy_rows in (1000, None):
        res = compare(occ, POOLED, heavy_rows=heavy_rows, chunk_bits=1)
        for side, n in (("left", 12_000), ("right", 3_000)):
            own = sorted(((r.file, r.line_no, r.occ_rank, r.bucket) for r in res.where(F.col("side") == side).collect()), reverse=True)
            assert [r[2] for r in own] == list(range(1, n + 1))
            assert sum(r[3].startswith("comm") for r in own) == 3_000


def test_every_heavy_key_is_found_from_few_lines(spark):
    """Zipf keys: all keys over the limit and none far below it, from one line in eight."""
    from bagdiff.operators.classify import heavy_keys

    n, limit = 400_000, 2000
    keys = spark.range(n).select(F.floor(F.exp(F.rand(5) * 12)).cast("string").alias("key")).cache()
    hashed = F.xxhash64("key").alias("h")
    counts = {r.h: r["count"] for r in keys.groupBy(hashed).count().collect()}
    found = heavy_keys(keys, [F.col("key")], limit)
    assert {h for h, c in counts.items() if c > limit} <= set(found)
    assert all(counts[h] > limit / 4 for h in found) and len(found) == len(set(found)) > 10
    assert len(counts) > 20 * len(found)
    # up to HEAVY_DRAWS lines every line is counted
    assert set(heavy_keys(keys, [F.col("key")], 100)) == {h for h, c in counts.items() if c > 100}


def test_more_heavy_keys_than_any_list_was_cut_to(spark):
    """6,000 heavy keys are all dealt to parts, and ranks stay the same."""
    from bagdiff.operators.classify import heavy_keys, rank_occurrences
    from bagdiff.plans.pipelines import with_key

    rows = spark.range(24_000).select(
        F.when(F.col("id") % 3 == 0, "right").otherwise("left").alias("side"),
        F.lit("f").alias("file"),
        (F.col("id") + 1).alias("line_no"),
        F.format_string("k%d", F.col("id") % 6000).alias("line"),
    )
    occ = with_key(rows)
    assert len(heavy_keys(occ, [F.col("key")], 3)) == 6000
    ranked = rank_occurrences(occ, heavy_rows=3, chunk_bits=3)
    assert ranked.exceptAll(rank_occurrences(occ, heavy_rows=None)).count() == 0 and ranked.count() == 24_000


def test_probe_decides_the_plan_not_the_result(spark):
    """Lines without numbers tell heavy keys; a probe that misses them gives the same rows."""
    rows = [("left", "f", i + 1, "x" if i % 2 else f"v{i}") for i in range(400)] + [("right", "f", i + 1, "X") for i in range(90)]
    occ = spark.createDataFrame(rows, "side string, file string, line_no long, line string")
    bag = occ.select("side", "file", "line")
    want = sorted(compare(occ, FILES, heavy_rows=None).collect())
    plans = set()
    for probe in (None, bag, bag.limit(0)):
        res = compare(occ, FILES, heavy_rows=50, chunk_bits=4, probe=probe)
        assert sorted(res.collect()) == want
        plans.add("_part" in res._jdf.queryExecution().optimizedPlan().toString())
    assert plans == {True, False}


def test_pooled_order_is_file_then_line(spark):
    rows = [
        ("left", "a.txt", 1, "k"),
        ("left", "b.txt", 1, "k"),
        ("left", "b.txt", 2, "K"),
        ("right", "a.txt", 5, "k"),
    ]
    occ = spark.createDataFrame(rows, "side string, file string, line_no long, line string")
    res = compare(occ, POOLED, heavy_rows=0, chunk_bits=0).where(F.col("side") == "left").orderBy("occ_rank").collect()
    assert [(r.file, r.line_no, r.occ_rank, r.bucket) for r in res] == [
        ("b.txt", 2, 1, "comm_left"),
        ("b.txt", 1, 2, "diff_left"),
        ("a.txt", 1, 3, "diff_left"),
    ]


def test_hot_key_is_spread_over_partitions(spark):
    rows = [("left", "l.txt", i + 1, "" if i % 3 else f"v{i}") for i in range(6000)]
    rows += [("right", "r.txt", i + 1, "" if i % 2 else f"w{i}") for i in range(3000)]
    occ = spark.createDataFrame(rows, "side string, file string, line_no long, line string")
    res = compare(occ, FILES, heavy_rows=1000, chunk_bits=7)  # 128 lines per chunk
    hot = res.where(F.col("key") == "").select(F.spark_partition_id().alias("p"))
    # AQE would merge this tiny shuffle into one task; keep the 8 partitions
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    whole = compare(occ, FILES).where(F.col("key") == "").select(F.spark_partition_id().alias("p"))
    try:
        per_part = [r["count"] for r in hot.groupBy("p").count().collect()]
        unchunked = whole.select("p").distinct().count()
    finally:
        spark.conf.set(key, old)
    assert len(per_part) >= 4  # 5,500 blank lines in 47 chunks, over several tasks
    assert max(per_part) < 0.6 * sum(per_part)
    assert unchunked == 1  # not heavy: the key's lines meet in one task
