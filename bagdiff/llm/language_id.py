"""Language identification: multinomial naive Bayes over hashed character n-grams.

``fit`` counts the n-grams of every training text inside Spark tasks and sums the
counts per (language, bucket) with a hash aggregation; only the finished
log-probability matrix, whose size is bounded by ``MATRIX_BYTES``, reaches the
driver (as counts, at most four times as large) and is broadcast. A task holds the counts of
``HELD`` languages at most, whatever the column holds. ``predict`` looks the n-grams of a batch up in the
matrix and sums per document, in numpy.

Characters are lower-cased letters; every other character reads as a space, and
n-grams of spaces alone do not count. A text is read whole; one of over
``CHUNK_CHARS`` characters is read in pieces, as if a space stood at each cut.

Defined results: a null, empty or letterless text is ``und`` with score 0; with
no training rows every text is. Ties go to the language first in sorted order.
Repeated rows count, and are judged, once each. Rows with a null language do not
train. Columns other than those named are ignored by the model and kept by
``with_language``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagdiff.llm.common import CHUNK_CHARS, arrow_column, bound_batches, chunks, tidy

NGRAMS = (1, 2, 3)
BITS = 15
#: Bound of the broadcast matrix; with very many languages, buckets are folded until it fits.
MATRIX_BYTES = 64 << 20
#: Languages whose counts a task holds at once (262 KB each); with more, it passes them on and starts anew.
HELD = 128
#: A column of more distinct values is no column of languages; `fit` refuses it.
MOST_LANGUAGES = 1 << 20
UNKNOWN = "und"


@dataclass
class Model:
    """``matrix[bucket, language]`` of log probabilities (a last row of zeros for no n-gram) and log priors."""

    langs: list
    bits: int
    matrix: object
    prior: object


def _letters():
    """Lower-cased letter for each code point of the first plane, a space for the rest."""
    import numpy as np

    table = np.full(0x10000, 32, np.uint32)
    for i in range(0x10000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def _fold(text_points, table):
    import numpy as np

    other = text_points > 0xFFFF
    out = table[np.where(other, 0, text_points)]
    if other.any():  # letters beyond the first plane stand for themselves
        at = np.flatnonzero(other)
        out[at] = [p if chr(p).isalpha() else 32 for p in text_points[at].tolist()]
    return out


def _pieces(texts):
    """Texts cut to at most CHUNK_CHARS characters, with the row of each piece."""
    rows, parts = [], []
    for i, t in enumerate(texts):
        for s in range(0, max(len(t), 1), CHUNK_CHARS):
            rows.append(i)
            parts.append(t[s : s + CHUNK_CHARS])
    return rows, parts


def _ngrams(parts, table, bits):
    """For each n: buckets of the n-grams by start position, and where each part starts.

    Parts are set apart by two spaces, so no n-gram of up to three characters has
    letters of two parts. N-grams of spaces alone get the bucket after the last.
    """
    import numpy as np

    lens = np.fromiter(map(len, parts), np.int64, len(parts))
    joined = "  " + "  ".join(parts) + "  "
    points = _fold(np.frombuffer(joined.encode("utf-32-le"), np.uint32), table)
    starts = np.zeros(len(parts), np.int64)
    np.cumsum(lens[:-1] + 2, out=starts[1:])
    end = len(points) - 2
    hashes = np.zeros(end, np.uint32)
    blank = np.ones(end, bool)
    out = []
    for n in range(1, max(NGRAMS) + 1):
        ch = points[n - 1 : n - 1 + end]
        hashes = hashes * np.uint32(0x01000193) + ch + np.uint32(n)
        blank = blank & (ch == 32)
        if n in NGRAMS:
            mixed = (hashes ^ (hashes >> np.uint32(15))) * np.uint32(0x9E3779B1)
            bucket = (mixed >> np.uint32(32 - bits)).astype(np.int32)
            bucket[blank] = 1 << bits
            out.append(bucket)
    return out, starts


def _count(batches):
    """Arrow batches of (lang, text) to (lang, bucket, n): the counts of one task, bucket -1 for documents."""
    import numpy as np
    import pyarrow as pa

    table, counts, docs = _letters(), {}, {}
    size = 1 << BITS

    def counted():
        for lang, held in counts.items():
            at = np.flatnonzero(held[:size])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (len(at) + 1), pa.string()),
                    pa.array(np.append(at, -1), pa.int32()),
                    pa.array(np.append(held[at], docs[lang]), pa.int64()),
                ],
                ["lang", "bucket", "n"],
            )
        counts.clear()
        docs.clear()

    for batch in batches:
        langs = batch.column(0).to_pylist()
        for first, texts in chunks(batch.column(1)):
            by = {}
            for i, t in enumerate(texts):
                by.setdefault(langs[first + i], []).append(t)
            for lang, own in by.items():
                if lang not in counts and len(counts) == HELD:
                    yield from counted()
                docs[lang] = docs.get(lang, 0) + len(own)
                held = counts.setdefault(lang, np.zeros(size + 1, np.int64))
                for part in _pieces(own)[1] if sum(map(len, own)) > CHUNK_CHARS else ["  ".join(own)]:
                    for bucket in _ngrams([part], table, BITS)[0]:
                        held += np.bincount(bucket, minlength=size + 1)
    yield from counted()


def fit(df: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """Learn from every row of ``df`` whose language and text are not null; None if there is none.

    Raises ValueError for a column of over ``MOST_LANGUAGES`` distinct languages.
    """
    import numpy as np

    rows = df.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    bound_batches(df.sparkSession)
    counted = rows.mapInArrow(tidy(_count), "lang string, bucket int, n bigint")
    named = df.filter(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang")).distinct()
    names = sorted(r.lang for r in named.limit(MOST_LANGUAGES + 1).collect())
    if not names:
        return None
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"column {lang} has over {MOST_LANGUAGES} distinct languages")
    bits = min(BITS, int(math.log2(MATRIX_BYTES / 4 / len(names))))
    folded = F.when(F.col("bucket") >= 0, F.shiftright("bucket", BITS - bits)).otherwise(F.col("bucket"))
    summed = counted.groupBy("lang", folded.alias("bucket")).agg(F.sum("n").alias("n"))
    # the names stay in Spark: at most len(names) * 2^bits rows of 16 bytes, four times MATRIX_BYTES
    places = df.sparkSession.createDataFrame(list(enumerate(names)), "place int, lang string")
    table = summed.join(F.broadcast(places), "lang").select("place", "bucket", "n").toArrow()
    if not len(table):
        return None
    used, col = np.unique(table["place"].to_numpy(), return_inverse=True)
    langs = [names[i] for i in used]
    bucket, n = table["bucket"].to_numpy(), table["n"].to_numpy()
    is_doc = bucket < 0
    docs = np.zeros(len(langs))
    np.add.at(docs, col[is_doc], n[is_doc])
    grams = np.zeros((1 << bits, len(langs)))
    np.add.at(grams, (bucket[~is_doc], col[~is_doc]), n[~is_doc])
    smooth = 0.5
    logp = np.log(grams + smooth) - np.log(grams.sum(axis=0) + smooth * len(grams))
    matrix = np.vstack([logp, np.zeros(len(langs))]).astype(np.float32)
    return Model(langs, bits, matrix, np.log(docs / docs.sum()))


def _judge(texts, model, table, letter):
    """(language, posterior probability) of each text."""
    import numpy as np

    rows, parts = _pieces(texts)
    total = np.tile(model.prior, (len(texts), 1))
    step, held, size = [], [], 0

    def add():
        buckets, starts = _ngrams(held, table, model.bits)
        for bucket in buckets:
            np.add.at(total, step, np.add.reduceat(model.matrix[bucket], starts, axis=0, dtype=np.float64))

    for r, p in zip(rows, parts, strict=True):
        if held and size + len(p) > CHUNK_CHARS:
            add()
            step, held, size = [], [], 0
        step.append(r)
        held.append(p)
        size += len(p)
    if held:
        add()
    best = total.argmax(axis=1)
    odds = np.exp(total - total.max(axis=1, keepdims=True))
    score = 1.0 / odds.sum(axis=1)
    known = [letter(t) is not None for t in texts]
    return (
        [model.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known, strict=True)],
        np.where(known, score, 0.0),
    )


def language(model: Model | None, text: Column, spark) -> Column:
    """struct(lang_pred, score) of a text column."""
    schema = "struct<lang_pred:string,score:double>"
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa
        import regex

        held, table, letter = shared.value, _letters(), regex.compile(r"\p{L}").search
        for texts in batches:
            for _, part in chunks(texts):
                langs, scores = _judge(part, held, table, letter)
                yield pa.StructArray.from_arrays(
                    [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
                )

    return arrow_column(run, schema, text)


def with_language(df: DataFrame, model: Model | None, text: str = "text", into: str = "language") -> DataFrame:
    """``df`` with a column ``into``: struct(lang_pred, score). Rows are neither moved nor dropped."""
    return df.withColumn(into, language(model, F.col(text), df.sparkSession))
