"""The text-file path and the table path agree: documents written out as text
files (one file per side for X, one per source_lang for Y) and compared by the
file readers give the same rows as the contract queries on the table."""

from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from bagdiff import diff_dirs, diff_files, diff_pooled_dirs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def written(tmp_path_factory):
    root = tmp_path_factory.mktemp("docs")
    rows = duckdb.sql(
        f"""SELECT doc_id, text, source, lang, CASE WHEN (doc_id // 20) % 2 = 0 THEN 'left' ELSE 'right' END AS side
            FROM read_parquet('{SF}/documents.parquet') WHERE text IS NOT NULL ORDER BY doc_id"""
    ).fetchall()
    x, y = defaultdict(list), defaultdict(list)
    for _, text, source, lang, side in rows:
        lines = text.split("\n")
        x[side] += lines
        y[(side, f"{source}_{lang}.txt")] += lines
    for side, lines in x.items():
        (root / "x").mkdir(exist_ok=True)
        (root / "x" / f"{side}.txt").write_text("".join(line + "\n" for line in lines), encoding="utf-8")
    for (side, name), lines in y.items():
        (root / "y" / side).mkdir(parents=True, exist_ok=True)
        (root / "y" / side / name).write_text("".join(line + "\n" for line in lines), encoding="utf-8")
    return root


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_files(spark, written):
    res = diff_files(spark, str(written / "x" / "left.txt"), str(written / "x" / "right.txt"))
    cols = ["bucket", "line_no", "line", "key", "n_left", "n_right", "occ_rank"]
    assert _rows(res, cols) == _rows(E.queries()["diff_files"](spark, SF), cols)


def test_dirs(spark, written):
    res = diff_dirs(spark, str(written / "y" / "left"), str(written / "y" / "right"))
    cols = ["file", "bucket", "line_no", "line", "key"]
    assert _rows(res, cols) == _rows(E.queries()["diff_dirs"](spark, SF), cols)


def test_pooled_dirs(spark, written):
    res = diff_pooled_dirs(spark, str(written / "y" / "left"), str(written / "y" / "right"))
    cols = ["bucket", "line", "key", "n_left", "n_right"]
    assert _rows(res, cols) == _rows(E.queries()["diff_pooled_dirs"](spark, SF), cols)


def test_pooled_scan_needle(spark, written):
    from bagdiff.plans.pipelines import keep_needle, with_key
    from bagdiff.sources import read_sides

    occ = read_sides(spark, {"left": str(written / "y" / "left"), "right": str(written / "y" / "right")})
    res = keep_needle(with_key(occ), "the")
    assert _rows(res, ["side", "line", "key"]) == _rows(E.queries()["pooled_scan"](spark, SF), ["side", "line", "key"])
    assert res.where(F.col("key").contains("the")).count() == res.count()
