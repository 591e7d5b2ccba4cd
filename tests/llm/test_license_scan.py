from __future__ import annotations

import random
import re

import duckdb

from bagdiff.llm import license_scan, queries


def compare(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?)", rows)

    def query(docs):
        real = queries._table
        queries._table = lambda *_: docs
        try:
            return queries.op5_license_scan(spark, "")
        finally:
            queries._table = real

    got = sorted(map(tuple, query(df).collect()), key=repr)
    want = sorted(con.sql(queries.oracle_sql()["op5_license_scan"]).fetchall(), key=repr)
    assert got == want
    return {r[0]: r for r in got}


def test_notices_cut_damaged_and_scattered(spark):
    """Templates with words dropped, added and shuffled, at all places of long texts, against every pair compared."""
    rnd = random.Random(7)
    vocabulary = [w for _, t in license_scan.TEMPLATES for w in license_scan.template_words(t)] + ["x", "y", "z"] * 30
    rows = []
    for i in range(250):
        words = rnd.choices(vocabulary, k=rnd.randrange(0, 150))
        for _ in range(rnd.randrange(3)):
            notice = license_scan.template_words(rnd.choice(license_scan.TEMPLATES)[1])
            for _ in range(rnd.randrange(3)):
                notice.pop(rnd.randrange(len(notice)))
            if rnd.random() < 0.3:
                rnd.shuffle(notice)
            at = rnd.randrange(len(words) + 1)
            words[at:at] = notice
        rows.append((i, rnd.choice([" ", ", ", "\n"]).join(w.upper() if rnd.random() < 0.2 else w for w in words)))
    found = compare(spark, rows)
    assert sum(r[6] != "" for r in found.values()) > 60


def test_base_places(spark):
    rows = [
        (1, "MIT License, the mit-license; apache license and GNU general public license license mit license"),
        (2, "license mit"),
        (3, "general public\n\nLICENSE"),
        (4, None),
        (5, ""),
        (6, "Released under the MIT License."),
        (6, "Released under the MIT License."),
        (None, "This work is licensed under the GNU General Public License, version 3."),
        (7, "mit licensé éapache license"),
        (8, "a " * 100_000 + "Licensed under CC BY-NC 4.0."),
        (9, "Released under the BSD License; 'MIT' is a place"),
    ]
    found = compare(spark, rows)
    assert found[6][2:] == (1, 3, 3, "mit", "mit", 1.0)
    assert found[8][6] == "cc-by-nc" and found[8][7] == 1.0
    assert found[9][6] == ""  # the words of the notice do not stand together


def test_labels_by_hand(spark):
    """Labels of the method alone, written by hand."""
    full = {label: text for label, text in license_scan.TEMPLATES if label in ("mit", "isc")}
    filler = "one two three four five six seven eight nine ten eleven twelve "
    cases = [
        ("Licensed under CC BY-SA 4.0", ["cc-by-sa"]),
        ("Licensed under CC BY-NC 4.0.", ["cc-by-nc"]),
        ("Licensed under CC BY 4.0", ["cc-by"]),
        ("Licensed under CC BY-NC-SA 4.0", ["cc-by-nc-sa"]),
        ("Licensed under CC BY 4.0. " + filler * 2 + "Licensed under CC BY-SA 4.0.", ["cc-by", "cc-by-sa"]),
        ("It was licensed by 4 of them under a cc of 0 parts", []),
        ("Licensed " + filler + "under CC BY 4.0", []),
        ("Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ["cc-by-sa"]),
        ("Licensed under a Creative Commons Attribution 4.0 International License", ["cc-by"]),
        ("Released under the BSD License; MIT is a place", []),
        ("Licensed under the GNU Lesser General Public License, version 2.1", ["lgpl"]),
        (filler * 40 + full["isc"] + filler * 40, ["isc"]),
        (filler * 40 + full["mit"].replace("persons", "people") + filler * 40, ["mit"]),
        (full["isc"][: len(full["isc"]) // 2], []),
        (filler * 300, []),
    ]
    for text, at in [("Licensed under CC BY-ND 4.0", k) for k in range(13)]:  # wherever blocks begin
        cases.append((" ".join((filler * 2).split()[:at]) + " " + text + " " + filler, ["cc-by-nd"]))
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: [m.label for m in r.matches] for r in license_scan.scan(df).collect()}
    assert {i: v for i, v in got.items() if v != cases[i][1]} == {}


def test_blocks_follow_templates():
    templates = [("a", "x y"), ("b", "x y z"), ("b", "x y z w w"), ("c", "q"), ("a", "x y q q q q q q")]
    assert license_scan.block_words(templates) == [5, 5, 5, 8, 8]
    for n in range(1, 60):  # n consecutive words lie whole in one block
        length, step = license_scan.block_of(n)
        assert all(p + n <= p // step * step + length for p in range(200))


def test_odd_rows_and_plan(odd_docs, no_docs):
    out = license_scan.scan(odd_docs)
    assert out.count() == odd_docs.count()
    by = {r.doc_id: [m.label for m in r.matches] for r in out.collect()}
    assert by[8] == ["apache"] and by[6] == [] and by[3] == []
    assert license_scan.scan(no_docs).count() == 0
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().toString())
