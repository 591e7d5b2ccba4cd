from __future__ import annotations

import random
from itertools import combinations

import xxhash
from pyspark.sql import functions as F

from bagdiff.llm import simhash


def fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def clusters(fps, distance):
    """Smallest index reachable, by comparing all pairs."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= distance:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def expected(rows, distance=4):
    fps = [fingerprint(t) for _, t in rows]
    best, own = {}, clusters(fps, distance)
    for (i, _), c in zip(rows, own, strict=True):
        best[c] = min((x for x in (best.get(c), i) if x is not None), default=None)
    return sorted(((i, f, best[c]) for (i, _), f, c in zip(rows, fps, own, strict=True)), key=repr)


def got(df):
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in df.collect()), key=repr)


def test_documents(small):
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    assert got(simhash.near_duplicates(small)) == expected(rows)


def test_odd_rows(odd_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert got(simhash.near_duplicates(odd_docs)) == expected(rows)


def test_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.one_of_each(no_docs).columns == no_docs.columns


def test_spark_hash_agrees(spark):
    text = "Wörter sind hier vier"
    df = spark.createDataFrame([(text,)], "text string")
    native = df.select(F.xxhash64(F.lit(text.lower().replace("Ö", "ö")))).first()[0]
    assert df.select(simhash.fingerprint(F.col("text"))).first()[0] == native


def test_index_meets_every_minimum():
    for matches in range(1, 9):
        for size in (2, 3, 4):
            chosen = simhash.index_combinations(matches, size)
            assert all(any(set(c) <= set(x) for c in chosen) for x in combinations(range(8), matches))


def linked_sets(spark, fps, distance, list_max):
    from bagdiff.llm.components import components

    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = components(simhash.links(df, distance, list_max))
    label = {r.node: r.component for r in found.collect()}
    return [label.get(f, f) for f in signed]


def test_hot_lists_of_close_values(spark):
    """A crowd around one value, with all lists hot or none, for even and odd distances."""
    rnd = random.Random(3)
    centre = rnd.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(0, 8))) for _ in range(120)}
    fps = sorted(fps | {rnd.getrandbits(64) for _ in range(30)})
    for distance in (4, 3):
        own = clusters(fps, distance)
        for list_max in (1, 1000):
            labels = linked_sets(spark, fps, distance, list_max)
            assert len(set(zip(own, labels, strict=True))) == len(set(own)) == len(set(labels))


def test_one_of_each_keeps_columns(odd_docs):
    out = simhash.one_of_each(odd_docs)
    assert out.columns == odd_docs.columns
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    want = {x[2] for x in expected(rows)}
    assert {r.doc_id for r in out.select("doc_id").collect()} == want
