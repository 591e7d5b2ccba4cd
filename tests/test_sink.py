"""K1-K3: bucket output as CRLF text, in order, and output names."""

from conftest import occurrences
from pyspark.sql import functions as F

import os

import pytest

from bagdiff import schema as S
from bagdiff import DIRS, POOLED, compare, diff_lines, render, side_label, write_result
from bagdiff.plans import contract
from bagdiff.session import scratch_path
from bagdiff.sources import output_names, read_bucket, read_output
from test_golden import EXPECTED, LEFT, RIGHT


def lines_of(rows):
    return [piece for row in rows for piece in row.replace(", ", ",\n").split("\n")]


def read_in_order(df):
    return [r.value for r in df.orderBy("part_file", "_m").collect()]


def test_write_and_read_back(spark):
    res = diff_lines(occurrences(spark, LEFT, "left"), occurrences(spark, RIGHT, "right"))
    path = scratch_path(spark, "sink")
    write_result(res, path)
    for bucket, rows in EXPECTED.items():
        assert read_in_order(read_bucket(spark, path, bucket)) == lines_of(rows)
    import glob

    raw = b"".join(open(f, "rb").read() for f in sorted(glob.glob(path.replace("file:", "") + "/bucket=diff_left/part-*")))
    assert raw == b"[4:apple,\r\n1:Apple]\r\n[6:only left]\r\n"


def test_output_names(spark):
    labels = spark.createDataFrame([("left", "dirOne/a.txt"), ("right", "x/y.z/b.c.txt")], "side string, label string")
    rows = output_names(labels).orderBy("bucket").collect()
    assert [(r.bucket, r.name) for r in rows] == [
        ("comm_left", "Comm a.txt"),
        ("comm_right", "Comm y.txt"),
        ("diff_left", "Diff a.txt"),
        ("diff_right", "Diff y.txt"),
    ]


def test_labels(spark):
    from bagdiff.functions import default_label, dir_label

    r = spark.range(1).select(
        dir_label(F.lit("C:\\Users\\dirOne\\***.***")).alias("d"),
        dir_label(F.lit("/data/dirTwo/*")).alias("e"),
        default_label(F.lit("a.txt")).alias("f"),
    ).first()
    assert (r.d, r.e, r.f) == ("目录dirOne", "目录dirTwo", "文件a.txt")


def test_command_line(spark, tmp_path):
    from bagdiff.__main__ import main

    a, b = tmp_path / "a.txt", tmp_path / "b.txt"
    a.write_text("".join(x + "\n" for x in LEFT))
    b.write_text("".join(x + "\n" for x in RIGHT))
    out = tmp_path / "out"
    main(["files", str(a), str(b), str(out)])
    for name, bucket in (("Comm a", "comm_left"), ("Diff a", "diff_left"), ("Comm b", "comm_right"), ("Diff b", "diff_right")):
        assert read_in_order(read_output(spark, f"{out}/output={name}.txt")) == lines_of(EXPECTED[bucket])


def test_named_outputs(spark, tmp_path):
    from bagdiff.sources import bucket_names

    assert bucket_names("dirOne/a.txt", "dirOne/a.csv") is None  # the reference would overwrite
    res = diff_lines(occurrences(spark, LEFT, "left"), occurrences(spark, RIGHT, "right"))
    out = str(tmp_path / "named")
    write_result(res, out, labels=("a.txt", "b.txt"))
    assert sorted(n for n in os.listdir(out) if not n.startswith(".")) == sorted(
        ["_COMPLETE", "_SUCCESS", "output=Comm 文件a.txt", "output=Diff 文件a.txt", "output=Comm 文件b.txt", "output=Diff 文件b.txt"]
    )
    assert read_in_order(read_output(spark, f"{out}/output=Diff 文件a.txt")) == lines_of(EXPECTED["diff_left"])


def test_labels_of_the_modes():
    assert side_label("a.txt") == "文件a.txt"
    assert side_label("C:\\Users\\dirOne\\***.***", DIRS) == side_label("x/dirOne/", DIRS) == side_label("dirOne", DIRS) == "目录dirOne"
    assert side_label("dirOne/", POOLED) == "目录dirOne/"


@pytest.mark.parametrize("labels", [None, ("dirOne/a.txt", "dirTwo/b.txt")])
def test_thousands_of_rows_in_order(spark, tmp_path, labels):
    """Every output of at least 3,000 rows over 8 partitions is in order of its first entries."""
    lines = contract.x_lines(spark, "/root/testdata/sf0.01")
    res = compare(lines)
    out = str(tmp_path / "out")
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # else these few rows are one partition
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        write_result(res, out, labels=labels)
    finally:
        spark.conf.set(key, old)
    entries = render(res).orderBy("first_file", "first_line_no", "position").collect()
    for bucket, name in (("comm_left", "Comm a"), ("diff_left", "Diff a"), ("comm_right", "Comm b"), ("diff_right", "Diff b")):
        folder = f"{out}/output={name}.txt" if labels else f"{out}/bucket={bucket}"
        want = [r.piece for r in entries if r.bucket == bucket]
        assert len(want) > (3000 if bucket.startswith("diff") else 500)
        assert read_in_order(read_output(spark, folder)) == want
        assert labels or len([f for f in os.listdir(folder) if f.startswith("part-")]) > 1 or bucket.startswith("comm")


def test_all_four_outputs_exist(spark, tmp_path):
    same = occurrences(spark, ["a", "b"], "left"), occurrences(spark, ["a", "b"], "right")
    for labels, folder in ((None, "bucket=diff_left"), (("x/a.txt", "x/b%1.txt"), "output=Diff a.txt")):
        out = str(tmp_path / folder)
        write_result(diff_lines(*same), out, labels=labels)
        assert len([n for n in os.listdir(out) if "=" in n]) == 4
        assert read_in_order(read_output(spark, f"{out}/{folder}")) == []
    with pytest.raises(Exception, match="exists"):
        write_result(diff_lines(*same), out)


def test_complete_only_after_all_outputs(spark, tmp_path, monkeypatch):
    from bagdiff.sources import sinks

    same = [occurrences(spark, ["a"], side) for side in ("left", "right")]
    out = str(tmp_path / "done")
    assert not sinks.is_complete(spark, out)
    write_result(diff_lines(*same), out)
    assert sinks.is_complete(spark, out)
    assert {p.name for p in (tmp_path / "done").iterdir() if p.is_dir()} == {f"bucket={b}" for b in S.BUCKETS} | {sinks.COMPLETE}
    # a crash while the empty outputs are made
    monkeypatch.setattr(sinks, "_folder", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        write_result(diff_lines(*same), str(tmp_path / "half"))
    assert not sinks.is_complete(spark, str(tmp_path / "half"))
