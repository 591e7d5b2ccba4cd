from __future__ import annotations

import copy
import json
import random
import struct

import pytest
from tokenizers import Tokenizer

from bagdiff.llm import bpe, queries

PATH = queries.vocabulary_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(encoder, vocab, library, texts):
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == struct.pack(f"<{len(want)}I", *want), text[:80]
        assert bpe._decode(ids, vocab.token_bytes) == library.decode(want, skip_special_tokens=False)


def test_random_texts(library):
    rnd = random.Random(1)
    alphabet = [*"aaabc  \n\t'sdtlm.,!09é中\xa0 \x1c\x85😀́Ⅷ²ß\r\x0b\x0c　", "<|endoftext|>", "'ll", " \n ", "the "]
    texts = ["".join(rnd.choices(alphabet, k=rnd.randrange(80))) for _ in range(3000)]
    texts += ["", "a" * 5000, "ab" * 3000, "<|endoftext|>" * 3, " " * 999 + "x", "\n" * 500, "é" * 777, "<|endoftext|"]
    vocab = bpe.load(PATH)
    encoder = bpe._Encoder(vocab)
    for s in range(0, len(texts), 500):
        check(encoder, vocab, library, texts[s : s + 500])


def test_forgetting_changes_nothing(library, small, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    vocab = bpe.load(PATH)
    encoder = bpe._Encoder(vocab)
    texts = [r.text or "" for r in small.limit(60).collect()]
    for s in range(0, len(texts), 7):
        check(encoder, vocab, library, texts[s : s + 7])


def test_query_and_odd_rows(odd_docs, no_docs, library):
    import hashlib

    rows = queries.tokenized(odd_docs).collect()
    texts = [r.text or "" for r in odd_docs.select("text").collect()]
    want = []
    for r, t in zip(odd_docs.select("doc_id").collect(), texts, strict=True):
        ids = library.encode(t, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        want.append((r.doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert queries.tokenized(no_docs).count() == 0
    kept = bpe.encode(odd_docs.drop("ids"), PATH)
    assert kept.columns == [*odd_docs.drop("ids").columns, "ids"]


def test_decode_of_broken_utf8_and_unknown_ids(library):
    vocab = bpe.load(PATH)
    half = library.encode("😀", add_special_tokens=False).ids[:1]
    assert bpe._decode(struct.pack("<2I", half[0], 999_999), vocab.token_bytes) == library.decode(half)


def test_files_of_other_kinds_are_refused():
    with pytest.raises(ValueError):
        bpe.load(queries.vocabulary_path("word_bpe_49k.json"))


def test_refuses_what_it_does_not_support(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        held = json.load(f)
    changes = [lambda h: h["pre_tokenizer"].update(use_regex=False), lambda h: h.update(decoder=None)]
    for key in ("lstrip", "rstrip", "single_word"):
        changes.append(lambda h, key=key: h["added_tokens"][0].update({key: True}))
    for i, change in enumerate(changes):
        other = copy.deepcopy(held)
        change(other)
        path = tmp_path / f"{i}.json"
        path.write_text(json.dumps(other))
        with pytest.raises(ValueError):
            bpe.load(str(path))


def test_encoding_holds_little_beside_what_it_remembers():
    """Units are numbered and ids written text by text, and places take 4 bytes each."""
    import tracemalloc

    vocab = bpe.load(PATH)
    encoder = bpe._Encoder(vocab)
    rnd = random.Random(2)
    words = ["".join(rnd.choices("abcdefgh", k=6)) for _ in range(20_000)]
    texts = [" ".join(rnd.choices(words, k=300)) for _ in range(700)]
    encoder.encode(texts[:1])
    tracemalloc.start()
    encoder.encode(texts)
    now, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak - now < 10 * sum(map(len, texts))  # 13 when all were numbered and written as one array
