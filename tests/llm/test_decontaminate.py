from __future__ import annotations

import random
import re

from bagdiff.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def expected(docs, items):
    """All windows of all texts compared."""
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    sizes = {len(w) for w in windows}
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=repr)


def check(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, decontaminate.find_hits(d, b).collect()), key=repr) == expected(docs, items)


def test_random_texts_of_few_words(spark):
    """Few different words give spans of every length, overlaps, repeats and ties of hashes."""
    rnd = random.Random(11)

    def text(n, size):
        return rnd.choice([" ", ", ", "--"]).join(rnd.choice("abcdefgh"[:size] + "É") for _ in range(n))

    items = [(i, text(rnd.randrange(0, 30), 8)) for i in range(40)]
    docs = [(i, text(rnd.randrange(0, 200), 8)) for i in range(60)]
    for i in range(30):
        part = rnd.choice(items)[1]
        docs.append((100 + i, text(20, 8) + " " + part.upper() + " " + text(20, 8)))
    check(spark, docs, items + [(2, items[0][1]), (None, "a b c d e f g h a b"), (50, None), (51, "..")])
    check(spark, [(i, "a " * i) for i in range(40)], [(1, "a " * 12), (2, "a a a")])


def test_spans_at_every_offset(spark):
    """Spans of 9 to 12 words of an item, with other words around."""
    rnd = random.Random(4)
    item = [f"w{rnd.randrange(9999)}" for _ in range(40)]
    docs = []
    for size in (9, 10, 11, 12):
        for at in range(40 - size + 1):
            docs.append((len(docs), " ".join([f"x{rnd.random()}".replace(".", ""), *item[at : at + size], "end"])))
    check(spark, docs, [(7, " ".join(item))])


def test_filter_lets_everything_wanted_through(spark, monkeypatch):
    """A filter of few bits lets unwanted hashes through; results stay."""
    monkeypatch.setattr(decontaminate, "FILTER_BITS", 15)
    rnd = random.Random(1)
    items = [(i, " ".join(f"w{rnd.randrange(50)}" for _ in range(200))) for i in range(20)]
    docs = [(i, " ".join(f"w{rnd.randrange(50)}" for _ in range(100)) + " " + items[i % 20][1][: 30 + i]) for i in range(40)]
    check(spark, docs, items)


def test_documents(spark, small):
    docs = [tuple(r) for r in small.select("doc_id", "text").collect()]
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    check(spark, docs, [tuple(r) for r in bench.select("item_id", "text").collect()])


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "the cat SAT on the mat and looked at the dog"), (2, "")], "item_id long, text string")
    none = items.limit(0)
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    got = sorted(map(tuple, decontaminate.find_hits(odd_docs, items).collect()), key=repr)
    assert got == expected(docs, [tuple(r) for r in items.collect()])
    assert {r.n_hit for r in decontaminate.find_hits(odd_docs, none).collect()} == {0}
    assert decontaminate.find_hits(no_docs, items).count() == 0
    kept = decontaminate.clean_rows(odd_docs, items)
    assert kept.columns == odd_docs.columns
    ids = sorted((r.doc_id for r in kept.select("doc_id").collect()), key=repr)
    assert ids == sorted([3, 4, None, None, 5, 6, 7, 8, 9], key=repr)


def test_surroundings_are_compared_once(spark, monkeypatch):
    """A filter on the comparison must not run it a second time, which takes a second Python worker a task."""
    plans, write = {}, decontaminate.materialize

    def noted(df, name, **options):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name, **options)

    monkeypatch.setattr(decontaminate, "materialize", noted)
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "x b c d e f g h i j k y"), (2, "")], "item_id long, text string")
    assert sorted(map(tuple, decontaminate.find_hits(docs, items).collect())) == [(1, 12, 10, ["1"]), (2, 0, 0, [])]
    for name in ("bench-items", "doc-hits"):
        assert plans[name].split("== Initial Plan ==")[0].count("ArrowEvalPython") == 1, plans[name]
