from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from bagdiff.llm import exact_dedup


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        own = groups[norm(t)]
        keep = min((x for x in own if x is not None), default=None)
        out.append((i, keep, len(own), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    df = df.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")))
    return sorted(map(tuple, df.collect()), key=repr)


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert got(exact_dedup.group_copies(odd_docs)) == expected(rows)


def test_empty_table(no_docs):
    assert exact_dedup.group_copies(no_docs).count() == 0
    assert exact_dedup.kept_rows(no_docs).columns == no_docs.columns


def test_equal_digests_of_different_texts(small):
    """A digest of one of 16 values: texts must still be compared in full."""
    exact = exact_dedup.group_copies(small).drop("digest")
    weak = exact_dedup.group_copies(small, digest=lambda t: F.hex(F.pmod(F.length(t), F.lit(16)))).drop("digest")
    assert sorted(map(tuple, weak.collect())) == sorted(map(tuple, exact.collect()))


def test_one_text_holds_most_rows(spark):
    """Large groups take the broadcast path; the others the shuffled one."""
    df = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise((F.col("id") % 1000).cast("string")).alias("text")
    )
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert got(exact_dedup.group_copies(df)) == expected(rows)


def test_kept_rows_keep_columns(odd_docs):
    out = exact_dedup.kept_rows(odd_docs)
    assert out.columns == odd_docs.columns
    ids = sorted((r.doc_id for r in out.select("doc_id").collect()), key=repr)
    # 1 twice: a repeated row is the same document; the nulls lose to 9 and to 3
    assert ids == sorted([1, 1, 3, 5, 6, 7, 8, 9], key=repr)


def test_main_path_has_no_python(small):
    plan = exact_dedup.group_copies(small)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
