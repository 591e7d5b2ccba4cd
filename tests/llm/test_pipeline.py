"""The pipeline against brute force, stage by stage."""

from __future__ import annotations

import hashlib
import struct

import regex
from .test_decontaminate import expected as hits
from .test_exact_dedup import norm
from .test_simhash import expected as near
from tokenizers import Tokenizer

import corpus_pipeline
from bagdiff.llm import decontaminate, exact_dedup, queries, simhash


def model(rows, items):
    """(doc_id, text) rows that stay, in brute force."""
    rows = [(i, t) for i, t in rows if regex.search(r"\p{L}", t or "")]
    first = {}
    for i, t in rows:
        first[norm(t)] = min((x for x in (first.get(norm(t)), i) if x is not None), default=None)
    rows = [(i, t) for i, t in rows if first[norm(t)] == i]
    stay = {c for _, _, c in near(rows)}
    rows = [(i, t) for i, t in rows if i in stay]
    dirty = {i for i, _, n, _ in hits(rows, items) if n}
    return [(i, t) for i, t in rows if i not in dirty]


def tokens(rows):
    library = Tokenizer.from_file(queries.vocabulary_path())
    out = []
    for i, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        packed = struct.pack(f"<{len(ids)}I", *ids)
        out.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_whole_pipeline(spark, small):
    sf_dir = "/root/testdata/sf0.001"
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    want = tokens(model([tuple(r) for r in small.select("doc_id", "text").collect()], items))
    assert 0 < len(want) < small.count()
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()), key=repr) == want


def test_stages_on_odd_rows_keep_columns(spark, odd_docs, tmp_path):
    bench = spark.createDataFrame([(1, "Der Hund und die Katze sind nicht in dem Garten, sondern auf")], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == odd_docs.columns
    out = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert sorted({r.doc_id for r in out.collect()}) == [1, 6, 8]


def test_copies_that_share_an_id_or_have_none(spark):
    """One row of each group, also where a table is loaded twice, ids are null, or an id names several texts."""
    a = "The first text has a number of words that no other text of this table has in this order, none of them."
    b = "Zwei Hunde laufen durch den Garten und suchen nach einem Ball, den das Kind gestern dort verloren hat."
    c = "El perro y el gato duermen en la casa grande que esta al lado del rio, lejos de la ciudad y del ruido."
    rows = [(1, a), (1, a), (1, a.replace(" ", "  ")), (None, b), (None, b), (1, c), (0, c), (7, b + " Ja."), (7, b + " Ja.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(r.doc_id, norm(r.text)) for r in corpus_pipeline.exact_stage(spark, docs, "").collect()]
    assert sorted(got, key=repr) == sorted([(1, a), (None, b), (0, c), (7, b + " Ja.")], key=repr)
    components = {(x[1], x[2]) for x in near([(i, norm(t)) for i, t in rows])}
    got = [(r.doc_id, norm(r.text)) for r in corpus_pipeline.near_stage(spark, docs, "").collect()]
    assert (1, a) in got and (0, c) in got and (1, c) not in got
    assert len(got) == len(set(got)) and len(got) <= len(components)


def test_texts_do_not_move_while_few_rows_go(spark, small):
    """The rows of a stage come from an anti-join with a broadcast of what goes, not from an exchange of texts."""
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    for out in (exact_dedup.one_of_each(small), simhash.one_of_each(small), decontaminate.clean_rows(small, items)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti" in plan and "hashpartitioning" not in plan, plan


def test_tables_of_finished_stages_are_removed(spark, tmp_path):
    from pathlib import Path

    from bagdiff.llm.common import materialize, remove, written

    rows = spark.range(5)
    with written() as tables:
        kept = materialize(materialize(rows, "inner"), "outer")
    assert [Path(p.removeprefix("file:")).name.split("-")[0] for p in tables] == ["inner", "outer"]
    remove(spark, tables[:-1])
    assert [Path(p.removeprefix("file:")).exists() for p in tables] == [False, True]
    assert kept.count() == 5


def test_without_any_language_texts_with_letters_stay(spark):
    rows = [(1, "A clean text.", None), (2, "中文", None), (3, "123 !", None), (4, "", None), (5, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in corpus_pipeline.language_stage(spark, docs, "").collect()) == [1, 2]


def test_empty_table(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.count() == 0


def test_stages_are_the_ones_asked_for():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id",
        "exact_dedup",
        "simhash_near_dedup",
        "benchmark_decontamination",
        "bpe",
    ]
