"""Text files, directories, pairing and pooled scans."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bagdiff import diff_dirs, diff_files, diff_pooled_dirs
from bagdiff.sources import list_files, read_lines, read_sides, scan_text


def _write(path: Path, data: bytes):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    d = root / "one"
    _write(d / "mix.txt", b"\xef\xbb\xbfa\rb\r\nc\n\nd")
    _write(d / "gbk.txt", "中文行\nAbC\n".encode("gbk"))
    _write(d / "empty.txt", b"")
    _write(d / "a b.c.txt", b"one\n")
    _write(d / "a+b.txt", b"one\n")
    _write(d / "中.txt", b"one\n")
    _write(d / ".hidden", b"one\n")
    _write(d / "_hidden", b"one\n")
    _write(d / "delim.txt", b"xSplitOney\nplain\n")
    return root


def test_line_ends_and_bom(spark, tree):
    rows = read_lines(spark, str(tree / "one" / "mix.txt"), "left").orderBy("line_no").collect()
    assert [(r.line_no, r.line) for r in rows] == [(1, "a"), (2, "b"), (3, "c"), (4, ""), (5, "d")]
    assert rows[0].file.endswith("/one/mix.txt")


def test_charset(spark, tree):
    rows = read_lines(spark, str(tree / "one" / "gbk.txt"), "left", encoding="GBK").orderBy("line_no").collect()
    assert [r.line for r in rows] == ["中文行", "AbC"]
    with pytest.raises(ValueError):
        read_lines(spark, str(tree / "one" / "gbk.txt"), "left", encoding="UTF-16")


def test_listing(spark, tree):
    files = {r.file_name: r for r in list_files(spark, str(tree / "one"), "left").collect()}
    assert set(files) == {"mix.txt", "gbk.txt", "empty.txt", "a b.c.txt", "a+b.txt", "中.txt", "delim.txt"}
    assert files["a b.c.txt"].stem == "a b"
    assert files["a+b.txt"].stem == "a+b"
    assert files["中.txt"].stem == "中"
    assert files["a+b.txt"].path.endswith("/one/a+b.txt")


def test_split_one_has_no_meaning(spark, tree):
    p = str(tree / "one" / "delim.txt")
    res = diff_files(spark, p, p).collect()
    assert sorted((r.bucket, r.line) for r in res) == [
        ("comm_left", "plain"),
        ("comm_left", "xSplitOney"),
        ("comm_right", "plain"),
        ("comm_right", "xSplitOney"),
    ]


def test_line_numbers_across_blocks(spark, tmp_path):
    n = 200_000
    p = tmp_path / "big.txt"
    p.write_text("".join(f"line {i}\n" for i in range(1, n + 1)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300000")
    try:
        df = read_lines(spark, str(p), "left")
        assert scan_text(spark, str(p)).rdd.getNumPartitions() > 4
        stats = df.agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("line") != F.concat(F.lit("line "), F.col("line_no").cast("string"))).alias("bad"),
        ).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert stats.n == n and stats.bad == 0


@pytest.mark.parametrize("encoding", ["UTF-16LE", "UTF-16BE", "UTF-32LE", "UTF-32BE"])
def test_wide_charsets(spark, tmp_path, encoding):
    """Lines of characters whose bytes look like a line feed's, cut into small blocks and sub-blocks."""
    import random

    rng = random.Random(7)
    some = ["a", "\u010a", "\u0a00", "\u0a05\u0100", "\u000c", "\U00010a0a", "\u0a0a", "\U000a0000", "é", " ", "\r", "\u0d0a"]
    lines = ["".join(rng.choice(some) for _ in range(rng.randrange(12))).rstrip("\r") for _ in range(3000)]
    ends = [rng.choice(["\n", "\r\n"]) for _ in lines]
    (tmp_path / "a.txt").write_bytes(("\ufeff" + "".join(x + e for x, e in zip(lines, ends))).encode(encoding))
    (tmp_path / "b.txt").write_bytes("no end".encode(encoding))
    (tmp_path / "c.txt").write_bytes(b"")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7001")
    try:
        rows = read_sides(spark, {"left": str(tmp_path)}, encoding, line_bits=4).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = sorted((r.line_no, r.line) for r in rows if r.file.endswith("a.txt"))
    assert got == list(enumerate(lines, 1))
    assert [(r.line_no, r.line) for r in rows if not r.file.endswith("a.txt")] == [(1, "no end")]


def test_a_file_that_cannot_be_split_is_many_sub_blocks(spark, tmp_path):
    """A gzip file is read by one task; its lines spread over the tasks of the exchange, with exact numbers."""
    import gzip

    n = 50_000
    for name in ("a.txt.gz", "b.txt.gz"):
        with gzip.open(tmp_path / name, "wt") as f:
            f.writelines(f"{name[0]} {i}\n" for i in range(1, n + 1))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        df = read_sides(spark, {"left": str(tmp_path)}, line_bits=10).withColumn("p", F.spark_partition_id())
        want = F.concat(F.substring(F.element_at(F.split("file", "/"), -1), 1, 1), F.lit(" "), F.col("line_no").cast("string"))
        assert df.where(F.col("line") != want).isEmpty()
        per_task = [r["count"] for r in df.groupBy("p").count().collect()]
    finally:
        spark.conf.set(key, old)
    assert sum(per_task) == 2 * n and len(per_task) == 8 and max(per_task) < 2 * n / 4


@pytest.fixture(scope="module")
def dirs(tmp_path_factory):
    root = tmp_path_factory.mktemp("dirs")
    left, right = root / "left", root / "right"
    _write(left / "a.txt", b"x\ny\ny\nZ\n")
    _write(right / "a.txt", b"y\nz\nw\n")
    _write(left / "only.txt", b"w\nq\n")
    _write(left / "x" / "d.txt", b"d1\n")
    _write(left / "y" / "d.txt", b"d2\n")
    _write(right / "d.txt", b"d1\n")
    _write(left / "e.txt", b"")
    _write(right / "e.txt", b"e\ne\n")
    return left, right


def test_dir_pairs(spark, dirs):
    left, right = dirs
    res = diff_dirs(spark, str(left), str(right)).collect()
    got = sorted((r.file, r.bucket, r.line_no, r.line) for r in res)
    assert got == [
        ("a.txt", "comm_left", 3, "y"),
        ("a.txt", "comm_left", 4, "Z"),
        ("a.txt", "comm_right", 1, "y"),
        ("a.txt", "comm_right", 2, "z"),
        ("a.txt", "diff_left", 1, "x"),
        ("a.txt", "diff_left", 2, "y"),
        ("a.txt", "diff_right", 3, "w"),
        ("e.txt", "diff_right", 1, "e"),
        ("e.txt", "diff_right", 2, "e"),
    ]


def test_dir_pairs_name_needle(spark, dirs):
    left, right = dirs
    res = diff_dirs(spark, str(left), str(right), name_needle="e").collect()
    assert {r.file for r in res} == {"e.txt"}


def test_pooled_dirs(spark, dirs):
    left, right = dirs
    res = diff_pooled_dirs(spark, str(left), str(right)).collect()
    by = {}
    for r in res:
        by.setdefault(r.bucket, []).append(r.line)
    # w: one on each side (only.txt counts when pooled); d1: one each side
    assert sorted(by["comm_left"]) == ["Z", "d1", "w", "y"]
    assert sorted(by["comm_right"]) == ["d1", "w", "y", "z"]
    assert sorted(by["diff_left"]) == ["d2", "q", "x", "y"]
    assert sorted(by["diff_right"]) == ["e", "e"]


def test_same_file_on_both_sides_across_blocks(spark, tmp_path):
    n = 60_000
    p = tmp_path / "self.txt"
    p.write_text("".join(f"line {i % 997}\n" for i in range(1, n + 1)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        res = diff_files(spark, str(p), str(p))
        stats = res.groupBy("side").agg(
            F.count(F.lit(1)).alias("n"),
            F.countDistinct("line_no").alias("distinct_no"),
            F.max("line_no").alias("max_no"),
            F.count_if(~F.col("bucket").startswith("comm_")).alias("not_common"),
            F.count_if(F.col("line") != F.concat(F.lit("line "), (F.col("line_no") % 997).cast("string"))).alias("bad"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(stats) == 2
    for r in stats:
        assert (r.n, r.distinct_no, r.max_no, r.not_common, r.bad) == (n, n, n, 0, 0)


def test_java_charset_needs_setting(spark, tree):
    spark.conf.set("spark.sql.legacy.javaCharsets", "false")
    try:
        with pytest.raises(ValueError, match="javaCharsets"):
            read_lines(spark, str(tree / "one" / "gbk.txt"), "left", encoding="GBK")
    finally:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")


def test_numbers_do_not_depend_on_packing(spark, tmp_path):
    """Split settings changed between building the plan and running it, and between runs."""
    p = tmp_path / "blocks.txt"
    p.write_text("".join(f"l{i}\n" for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
        rows = read_lines(spark, str(p), "left")
        wrong = rows.where(F.col("line") != F.concat(F.lit("l"), (F.col("line_no") - 1).cast("string")))
        for size in ("15000", "90000", "3000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert rows.agg(F.max("line_no"), F.count_distinct("line_no")).first()[:] == (20_000, 20_000)
            assert wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_nothing_runs_before_an_action(spark, dirs):
    """Reading runs nothing; a comparison looks for heavy keys unless it is told not to."""
    left, right = dirs
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "plan-only")
    try:
        read_sides(spark, {"left": str(left), "right": str(right)})
        diff_dirs(spark, str(left), str(right), needle="y", heavy_rows=None)
        assert len(tracker.getJobIdsForGroup("plan-only")) == 0
        diff_dirs(spark, str(left), str(right), needle="y")
        assert len(tracker.getJobIdsForGroup("plan-only")) > 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_recursion_switch(spark, tmp_path):
    """A copy in a folder below is a second path of the name, unless folders below are left out."""
    _write(tmp_path / "l" / "a.txt", b"x\n")
    _write(tmp_path / "l" / "sub" / "a.txt", b"y\n")
    _write(tmp_path / "r" / "a.txt", b"x\n")
    left, right = str(tmp_path / "l"), str(tmp_path / "r")
    assert diff_dirs(spark, left, right).count() == 0
    assert {r.bucket for r in diff_dirs(spark, left, right, recursive=False).collect()} == {"comm_left", "comm_right"}
    assert diff_pooled_dirs(spark, left, right).count() == 3
    assert diff_pooled_dirs(spark, left, right, recursive=False).count() == 2
    assert diff_files(spark, left, right, recursive=False).count() == 2


def test_dir_pairs_content_needle(spark, dirs):
    left, right = dirs
    res = diff_dirs(spark, str(left), str(right), needle="y").collect()
    # line numbers still count every line of the file
    assert sorted((r.file, r.bucket, r.line_no, r.line) for r in res) == [
        ("a.txt", "comm_left", 3, "y"),
        ("a.txt", "comm_right", 1, "y"),
        ("a.txt", "diff_left", 2, "y"),
    ]
