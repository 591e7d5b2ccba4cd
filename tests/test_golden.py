"""G1: the golden two-file case, at several chunk sizes."""

import pytest
from conftest import bucket_rows, emulate, occurrences
from pyspark.sql import functions as F

from bagdiff import diff_lines, render

LEFT = ["Apple", "b c", "", "apple", "APP LE", "only left"]
RIGHT = ["bC", "apple", "", "", "only right"]
EXPECTED = {
    "comm_left": ["[2:b c]", "[3:]", "[5:APP LE]"],
    "comm_right": ["[1:bC]", "[2:apple]", "[4:]"],
    "diff_left": ["[4:apple, 1:Apple]", "[6:only left]"],
    "diff_right": ["[3:]", "[5:only right]"],
}


@pytest.mark.parametrize("heavy_rows,chunk_bits", [(None, 20), (0, 0), (0, 1), (1, 20), (2, 1), (1 << 20, 20)])
def test_golden_buckets(spark, heavy_rows, chunk_bits):
    occ = occurrences(spark, LEFT, "left"), occurrences(spark, RIGHT, "right")
    assert bucket_rows(render(diff_lines(*occ, heavy_rows=heavy_rows, chunk_bits=chunk_bits))) == EXPECTED


def test_golden_matches_emulation(spark):
    buckets, rendered = emulate(LEFT, RIGHT)
    assert rendered == EXPECTED
    res = diff_lines(occurrences(spark, LEFT, "left"), occurrences(spark, RIGHT, "right"))
    got = {(r.side, r.line_no): r.bucket for r in res.select("side", "line_no", "bucket").collect()}
    assert got == buckets


def test_ranks_and_counts(spark):
    res = diff_lines(occurrences(spark, LEFT, "left"), occurrences(spark, RIGHT, "right"))
    apple = res.where(F.col("key") == "apple").orderBy("side", F.desc("line_no")).collect()
    assert [(r.side, r.line_no, r.occ_rank, r.n_left, r.n_right) for r in apple] == [
        ("left", 5, 1, 3, 1),
        ("left", 4, 2, 3, 1),
        ("left", 1, 3, 3, 1),
        ("right", 2, 1, 3, 1),
    ]


def test_input_without_file_column(spark):
    from bagdiff import compare
    from bagdiff.plans.pipelines import FILES

    occ = occurrences(spark, LEFT, "left").unionByName(occurrences(spark, RIGHT, "right")).drop("file")
    got = {(r.side, r.line_no): r.bucket for r in compare(occ, FILES).collect()}
    assert got == emulate(LEFT, RIGHT)[0]


def test_null_file_names_lose_no_line(spark):
    from bagdiff import compare
    from bagdiff.plans.pipelines import POOLED

    occ = occurrences(spark, LEFT, "left").unionByName(occurrences(spark, RIGHT, "right"))
    occ = occ.withColumn("file", F.lit(None).cast("string"))
    assert compare(occ, POOLED).count() == len(LEFT) + len(RIGHT)
