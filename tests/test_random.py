"""Randomised line lists against the pure-Python model."""

import random

from conftest import bucket_rows, emulate
from pyspark.sql import functions as F

from bagdiff import diff_lines, render

POOL = ["Apple", "a pple", "b c", "BC", "", "  ", "x:y", "q[1]", "z", "Z ", "w"]


def test_random_cases(spark):
    rng = random.Random(7)
    cases = []
    for case in range(12):
        left = [rng.choice(POOL) for _ in range(rng.randint(0, 14))]
        right = [rng.choice(POOL) for _ in range(rng.randint(0, 14))]
        flags = (rng.random() < 0.3, rng.random() < 0.3)
        cases.append((case, left, right, flags))
    # all cases in one job: the case id is the `file` grouping column
    rows = []
    for case, left, right, _ in cases:
        rows += [("left", f"c{case}", i + 1, line) for i, line in enumerate(left)]
        rows += [("right", f"c{case}", i + 1, line) for i, line in enumerate(right)]
    for flags in {c[3] for c in cases}:
        ids = [c[0] for c in cases if c[3] == flags]
        df = spark.createDataFrame(rows, "side string, file string, line_no long, line string").where(
            F.col("file").isin([f"c{i}" for i in ids])
        )
        from bagdiff.operators.classify import classify
        from bagdiff.plans.pipelines import with_key

        res = classify(with_key(df, *flags), by=("file",), heavy_rows=3, chunk_bits=2)
        got = {}
        for r in res.select("file", "side", "line_no", "bucket").collect():
            got.setdefault(r.file, {})[(r.side, r.line_no)] = r.bucket
        for case, left, right, f in cases:
            if f != flags:
                continue
            expected, _ = emulate(left, right, *flags)
            assert got.get(f"c{case}", {}) == expected, (case, left, right, flags)


def test_random_rendering(spark):
    rng = random.Random(11)
    left = [rng.choice(POOL) for _ in range(30)]
    right = [rng.choice(POOL) for _ in range(25)]
    from conftest import occurrences

    res = diff_lines(occurrences(spark, left, "left"), occurrences(spark, right, "right"), heavy_rows=4, chunk_bits=1)
    assert bucket_rows(render(res)) == emulate(left, right)[1]
