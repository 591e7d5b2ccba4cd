from __future__ import annotations

import random

import pytest
import sentencepiece

from bagdiff.llm import queries, token_counts

PATH = queries.vocabulary_path(queries.PIECES)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_sums_over_pre_tokens(library):
    rnd = random.Random(1)
    alphabet = [*"aaabc  \n\t'sdt.,!09é中\xa0 \x1c😀́Ⅷß\r\x0b\x0c　\x00▁", "<s>", "</s>", "<unk>", "<0x0A>", " \n ", "the ", "  ", "/s", "//", "(/", "-/x"]
    model = token_counts.load(PATH)
    cut, count = token_counts._Cutter(model), token_counts._pieces(model)
    texts = ["".join(rnd.choices(alphabet, k=rnd.randrange(40))) for _ in range(5000)]
    texts += ["", " ", "  ", "a" * 5000, "ab" * 3000, " " * 999 + "x", "\n" * 500, "é" * 777, "▁", "▁▁a", "a "]
    for t in texts:
        tokens = cut(t)
        assert "".join(tokens) == (" " + t.replace("▁", " ") if t else "")
        assert sum(count(tokens)) == len(library.encode(t)), t[:80]


@pytest.mark.parametrize("share", [None, 1])
def test_query(spark, small, library, share, monkeypatch):
    """The same counts when the frequent pre-tokens are broadcast and when all are joined."""
    if share:
        monkeypatch.setattr(token_counts, "HOT_SHARE", share)
    rows = queries.token_counts_of(small).collect()
    texts = {r.doc_id: r.text or "" for r in small.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        n = len(library.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


def test_hot_pre_tokens(spark, monkeypatch):
    """One with over 2 / HOT_SHARE of all pairs is found whatever task it is in; at most HOT_SHARE are."""
    monkeypatch.setattr(token_counts, "HOT_SHARE", 8)
    rows = [("a b" if i % 2 else f"a x{i}",) for i in range(200)] + [("a " + "x" * 100,)] * 300 + [(None,)]
    df = spark.createDataFrame(rows, "text string").repartition(7)
    got = {r.key: r.pieces for r in token_counts.hot_pre_tokens(df, PATH).collect()}
    assert {" a", token_counts._key(" " + "x" * 100)} <= set(got) and len(got) <= 8
    assert got[" a"] == 1 and max(map(len, got)) == token_counts.KEY_CHARS + 1


def test_odd_rows(odd_docs, no_docs, library):
    rows = token_counts.count_tokens(odd_docs, PATH, ["doc_id", "n", "key"]).collect()
    texts = [r.text or "" for r in odd_docs.select("text").collect()]
    assert sorted((r.n_bytes, r.n_tokens) for r in rows) == sorted((len(t.encode()), len(library.encode(t))) for t in texts)
    assert sum(r.doc_id is None for r in rows) == 2 and {r.n for r in rows} == {"own n"}
    assert queries.token_counts_of(no_docs).count() == 0


def test_models_that_do_not_fit_are_refused(tmp_path):
    data = open(PATH, "rb").read()
    assert b"\n\x08identity" in data
    other = tmp_path / "other.model"
    other.write_bytes(data.replace(b"\n\x08identity", b"\n\x08nmt_nfkc"))
    with pytest.raises(ValueError, match="normaliser"):
        token_counts.load(str(other))
