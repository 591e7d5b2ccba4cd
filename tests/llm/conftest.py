"""Fixtures shared by the operators' tests."""

from __future__ import annotations

import pytest

#: Columns that the operators use inside; a table may have them too.
CLASHING = (
    "id text2 key row digest norm salt keep_id kept n ids decoded fp component component_id language lang_pred score"
    " features spans words blocks places matches host path rule verdict node main_text n_words n_hit items found a b u v"
).split()


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    long = "The quick brown fox reads one more page of the long book. " * 8000
    rows = [
        (1, "The cat sat on the mat and looked at the dog in the garden.", "en", "a", 10),
        (1, "The cat sat on the mat and looked at the dog in the garden.", "en", "a", 10),
        (2, "The cat sat on  the mat\tand looked at the dog in the garden.", "en", None, None),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (None, "Der Hund und die Katze sind nicht in dem Garten, sondern auf der Wiese.", "de", "b", 3),
        (None, None, "de", "b", 3),
        (5, " \n\t ", "en", "b", 3),
        (6, long, "en", "c", len(long)),
        (7, "12345 !!! 678", "en", "c", 3),
        (8, "é ß 中 😀 \x1c Licensed under the Apache License, Version 2.0.", None, "c", 3),
        (9, "Der Hund und die Katze sind nicht in dem Garten, sondern auf der Wiese.", "de", "b", 3),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def small(spark):
    """The driver's documents of the smallest size."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
