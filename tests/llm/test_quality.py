from __future__ import annotations

from bagdiff.llm import quality, queries


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = queries.op10_quality(spark, sf_dir).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 500
    bad = [r for r in rows if r.quality == 0]
    good = [r for r in rows if r.quality == 1]
    assert sum(r.predicted == 0 for r in bad) / len(bad) >= 0.95
    assert sum(r.predicted == 1 for r in good) / len(good) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_ranking_follows_preferences(spark):
    docs = [(i, ("plain words of a text " * 5) if i % 3 else "### %%% $$$ &&& " * 9) for i in range(90)]
    labels = [(i, int(i % 3 > 0)) for i in range(90)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    ranking = quality.fit(d, spark.createDataFrame(labels, "doc_id long, quality int"))
    rows = quality.with_score(d, ranking).collect()
    assert min(r.score for r in rows if r.doc_id % 3) >= 0.3 > max(r.score for r in rows if r.doc_id % 3 == 0)


def test_sample_is_bounded(spark):
    docs = spark.range(500).selectExpr("id AS doc_id", "concat('word ', id, if(id % 2 = 0, ' !!! ### ###', ' and more')) AS text")
    labels = spark.range(500).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    ranking = quality.fit(docs, labels, sample=40, pairs=200)
    rows = quality.with_score(docs, ranking).collect()
    assert sum((r.score >= 0.3) == bool(r.doc_id % 2) for r in rows) >= 480


def test_threshold_covers_all_labelled_rows(spark):
    """The cut is that of all training labels, not of the sample, and scores are those of brute force."""
    import numpy as np

    docs = spark.range(600).selectExpr("id AS doc_id", "concat(repeat('word and more ', 1 + id % 7), if(id % 5 = 0, ' !!! ### ###', ''), id) AS text")
    rows = [(i, int(i % 5 > 0)) for i in range(0, 600, 2)] + [(2, 1), (None, 0), (4, None), (5000, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    ranking = quality.fit(docs, labels, sample=30, pairs=100)
    raw = quality.with_raw(docs, ranking)
    full = quality.calibrated(ranking, raw, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    own = [(ranking.raw(np.array([quality.features(texts[i])]))[0], y) for i, y in rows if i in texts and y is not None]
    scores, y = np.array([a for a, _ in own]), np.array([b for _, b in own])
    assert np.isclose(full.cut, np.quantile(scores, 1 - y.mean(), method="inverted_cdf")) and full.cut != ranking.cut
    assert np.isclose(full.scale, scores.std() / 2)
    for r in raw.withColumn("score", quality.score_of(raw["raw"], full)).collect():
        assert np.isclose(r.score, full.score(np.array([quality.features(r.text)]))[0])
    assert quality.calibrated(ranking, raw, labels.limit(0)) is ranking


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (7, 0), (3, 0), (99, 1), (None, 1), (5, None), (6, 2)], "doc_id long, quality int")
    for ranking in (quality.fit(odd_docs, labels), None):
        out = quality.with_score(odd_docs.drop("score"), ranking)
        assert out.columns == [*odd_docs.drop("score").columns, "score"]
        rows = out.collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.fit(no_docs, labels) is None
    assert quality.fit(odd_docs, labels.limit(0)) is None
    assert quality.with_score(no_docs, None).count() == 0
    assert quality.features("") == quality.features(" \n") == [0.0] * len(quality.FEATURES)
