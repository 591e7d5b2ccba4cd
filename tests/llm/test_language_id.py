from __future__ import annotations

from pyspark.sql import functions as F

from bagdiff.llm import language_id, queries


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = queries.op6_language_id(spark, sf_dir).join(docs, "doc_id").filter("held_out").collect()
    assert len(rows) > 300
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_matches_direct_naive_bayes(spark):
    """Few short texts: the same decisions as counting n-grams in dictionaries, without hashing."""
    from collections import Counter
    from math import log

    texts = {"aa": ["abab abba", "aab ba"], "bb": ["cdcd dc", "dcc cd cd"], "cc": ["xyz zyx", "zzy x"]}
    rows = [(lang, t) for lang, own in texts.items() for t in own]
    model = language_id.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert model.langs == ["aa", "bb", "cc"]

    def grams(t):
        t = f"  {t}  "
        return [t[i : i + n] for n in (1, 2, 3) for i in range(len(t)) if t[i : i + n].strip() and len(t[i : i + n]) == n]

    counts = {lang: Counter(g for t in own for g in grams(t)) for lang, own in texts.items()}

    def best(t):
        size = 1 << model.bits
        return max(
            texts, key=lambda x: sum(log((counts[x][g] + 0.5) / (sum(counts[x].values()) + 0.5 * size)) for g in grams(t))
        )

    for text in ("ab", "dcd", "zyz", "abx", "cda b", "ABBA!"):
        df = spark.createDataFrame([(text,)], "text string")
        assert language_id.with_language(df, model).first().language.lang_pred == best(text.lower().rstrip("!"))


def test_long_texts_and_batches_do_not_mix(spark, small, monkeypatch):
    """A text is judged alike alone, beside others, and cut to pieces."""
    model = language_id.fit(small)
    import regex

    texts = [r.text or "" for r in small.collect()]
    letter = regex.compile(r"\p{L}").search
    table = language_id._letters()
    together = language_id._judge(texts, model, table, letter)
    alone = [language_id._judge([t], model, table, letter) for t in texts]
    assert together[0] == [a[0][0] for a in alone]
    monkeypatch.setattr(language_id, "CHUNK_CHARS", 500)
    assert language_id._judge(texts, model, table, letter)[0] == together[0]


def test_odd_rows(odd_docs, no_docs):
    assert language_id.fit(no_docs) is None
    assert language_id.fit(odd_docs.withColumn("lang", F.lit(None).cast("string"))) is None
    model = language_id.fit(odd_docs)
    out = language_id.with_language(odd_docs, model, into="judged")
    assert out.columns == [*odd_docs.columns, "judged"]
    by = {r.doc_id: r.judged for r in out.collect()}
    assert [by[i].lang_pred for i in (3, 4, 5, 7)] == ["und"] * 4 and by[7].score == 0
    assert (by[1].lang_pred, by[6].lang_pred, by[9].lang_pred) == ("en", "en", "de")
    none = language_id.with_language(odd_docs, None, into="judged").collect()
    assert {(r.judged.lang_pred, r.judged.score) for r in none} == {("und", 0.0)}


def test_many_languages_fold_the_matrix(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MATRIX_BYTES", 4 * 40 * 64)
    rows = [(f"l{i:02}", chr(0x4E00 + i) * 30) for i in range(40)]
    model = language_id.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert model.bits == 6 and model.matrix.nbytes <= 4 * 40 * 65


def test_many_languages_in_a_task(spark, monkeypatch):
    """A task that may hold two languages gives the counts, and the model, of one that holds them all."""
    import numpy as np

    rows = [(f"l{i % 7}", chr(97 + i % 7) * 3 + " " + chr(98 + i % 5) * (1 + i % 4)) for i in range(70)]
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    whole = language_id.fit(df)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"lang": a, "text": t} for a, t in rows])

    def totals(found):
        out = {}
        for part in found:
            for r in part.to_pylist():
                out[r["lang"], r["bucket"]] = out.get((r["lang"], r["bucket"]), 0) + r["n"]
        return out

    want = totals(language_id._count([batch]))
    monkeypatch.setattr(language_id, "HELD", 2)
    parts = list(language_id._count([batch, batch]))
    assert len(parts) == 14 and totals(parts) == {k: 2 * n for k, n in want.items()}
    assert whole.langs == [f"l{i}" for i in range(7)] and np.isfinite(whole.matrix).all()


def test_too_many_languages_are_refused(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 2)
    df = spark.createDataFrame([(x, "text") for x in "abc"], "lang string, text string")
    with pytest.raises(ValueError, match="over 2 distinct"):
        language_id.fit(df)
