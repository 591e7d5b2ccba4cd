"""Benchmark decontamination by winnowing.

Words are runs of a-z, 0-9 and everything beyond ASCII, A-Z lower-cased. A window is
``span`` (10) consecutive words of an item; an item of fewer words is one window. A
document word inside any occurrence of a window is hit.

*Fingerprints.* Both sides hash every k-gram of words and keep the rightmost minimum
of each ``span - k + 1`` consecutive hashes. A shared span of ``span`` words holds
one whole such run of hashes, and both sides choose the same place in it, so no
occurrence is missed. Windows of n < ``span`` words are found the same way with
their own k, for the lengths n that the benchmark has.

*Join and extension.* Fingerprints join on their hash. Each carries the words around
it, as far as a window that contains it can reach; comparing these words extends a
hit to the exact shared span, and drops equal hashes of different words.

Only fingerprints that pass a bit filter of the benchmark's hashes leave the
documents' tasks. The filter has a fixed size (``FILTER_BITS``) whatever the
benchmark's; when it fills up it only lets more through to the join.

Defined results: null texts have no words; an item without words has no window.
Repeated items count once by id; a null item id is not counted as an item, though
its windows hit. Repeated documents are judged each for itself.
Other columns are ignored; ``clean_rows`` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagdiff.llm.common import arrow_column, chunks, materialize

SPAN = 10
GRAM = 5
#: Size of the bit filter of benchmark hashes: 4 MB.
FILTER_BITS = 25
_BLOCK = 1 << 15  # bits of one bitmap of bitmap_construct_agg

#: Every byte: itself if it belongs to a word, its lower case for A-Z, else a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_FOUND = "struct<span:int,hash:bigint,pos:int,before:int,words:string>"


class _Hashes(dict):
    """64-bit hash of each word, computed once; cleared when it has grown large."""

    def __missing__(self, word):
        import xxhash

        if len(self) > 200_000:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word, 7)
        return out


def _gram(span: int) -> int:
    return min(span, GRAM)


def _winnowed(hashes, ends, span):
    """(hash, place) of the kept k-grams over concatenated texts; ``ends``: where each text ends."""
    import numpy as np

    k = _gram(span)
    w = span - k + 1
    n = len(hashes) - k + 1
    if n < w:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = np.full(n, span, np.uint64)
    for i in range(k):
        grams = (grams ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        grams ^= grams >> np.uint64(29)
    m = n - w + 1
    best, place = grams[:m].copy(), np.zeros(m, np.int8)
    for i in range(1, w):
        now = grams[i : i + m]
        better = now <= best
        np.copyto(best, now, where=better)
        place[better] = i
    inside = np.ones(m, bool)  # windows that lie in one text
    for i in range(1, span):
        at = ends - i
        inside[at[(at >= 0) & (at < m)]] = False
    at = np.unique((np.arange(m) + place)[inside])
    return grams[at], at


def _scan(texts, spans, wanted, known):
    """For each text: (number of words, [(span, hash, place, words before, words around)])."""
    import numpy as np

    words, counts = [], []
    for t in texts:
        own = t.encode().translate(_WORD_BYTES).split()
        words += own
        counts.append(len(own))
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    ends = np.cumsum(counts)
    out = [(n, []) for n in counts]
    for span in spans:
        grams, at = _winnowed(hashes, ends, span)
        if wanted is not None:
            slot = (grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            hit = (wanted[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1
            grams, at = grams[hit.view(bool)], at[hit.view(bool)]
        reach, k = span - _gram(span), _gram(span)
        owner = np.searchsorted(ends, at, side="right")
        for g, p, o in zip(grams.view(np.int64).tolist(), at.tolist(), owner.tolist(), strict=True):
            end = int(ends[o])
            start = end - counts[o]
            low = max(start, p - reach)
            around = b" ".join(words[low : min(end, p + k + reach)]).decode()
            out[o][1].append((span, g, p - start, p - low, around))
    return out


def fingerprints(text: Column, spans: list[int], wanted: Column | None = None, spark=None, bits=None) -> Column:
    """struct(n_words, found): the words of a text and its winnowed fingerprints, those in the filter ``bits`` only."""
    shared = spark.sparkContext.broadcast(bits) if bits is not None else None

    def run(batches):
        import numpy as np
        import pyarrow as pa

        known = _Hashes()
        held = np.frombuffer(shared.value, np.uint8) if shared is not None else None
        kind = pa.list_(
            pa.struct(
                [("span", pa.int32()), ("hash", pa.int64()), ("pos", pa.int32()), ("before", pa.int32()), ("words", pa.string())]
            )
        )
        for texts in batches:
            for _, part in chunks(texts):
                got = _scan(part, spans, held, known)
                found = [[dict(zip(("span", "hash", "pos", "before", "words"), f, strict=True)) for f in x[1]] for x in got]
                yield pa.StructArray.from_arrays(
                    [pa.array([x[0] for x in got], pa.int64()), pa.array(found, kind)], ["n_words", "found"]
                )

    return arrow_column(run, f"struct<n_words:bigint,found:array<{_FOUND}>>", text)


def _reach() -> Column:
    """(start, end) of the words shared around a joined fingerprint, as document places; null if under a window."""

    def run(span, pos, before, words, i_before, i_words):
        import pyarrow as pa

        starts, ends = [], []
        cols = [c.to_pylist() for c in (span, pos, before, words, i_before, i_words)]
        for n, p, b, w, ib, iw in zip(*cols, strict=True):
            x, y, k = w.split(" "), iw.split(" "), _gram(n)
            left = 0
            while left < min(b, ib) and x[b - left - 1] == y[ib - left - 1]:
                left += 1
            right = 0
            while right < min(len(x) - b, len(y) - ib) and x[b + right] == y[ib + right]:
                right += 1
            whole = right >= k and left + right >= n
            starts.append(p - left if whole else None)
            ends.append(p + right if whole else None)
        return pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["start", "end"])

    import pyarrow as pa

    run.__annotations__ = dict.fromkeys(("span", "pos", "before", "words", "i_before", "i_words", "return"), pa.Array)
    # as nondeterministic, a filter on it stays above it: below, it would run again, in a worker of its own
    return F.arrow_udf(run, "struct<start:int,end:int>").asNondeterministic()("span", "pos", "before", "words", "i_before", "i_words")


def _filter_bits(items: DataFrame) -> bytes:
    """Bit filter of the hashes: 2^FILTER_BITS bits, built by tasks; the driver gets its bounded blocks only."""
    import numpy as np

    slot = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    blocks = items.groupBy(F.shiftright(slot, 15).cast("int").alias("block")).agg(
        F.bitmap_construct_agg(slot.bitwiseAND(_BLOCK - 1)).alias("bits")
    )
    held = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    size = _BLOCK // 8
    for r in blocks.collect():  # at most 2^(FILTER_BITS - 15) rows of 4 KB
        held[r.block * size : (r.block + 1) * size] = np.frombuffer(bytes(r.bits), np.uint8)
    return held.tobytes()


def find_hits(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``id``, n_words, n_hit, items (array of item ids as strings, sorted)."""
    spark = docs.sparkSession
    bench = items.select(F.col(item).alias("item"), F.col(item_text).alias("text")).distinct()
    sized = bench.withColumn("n", fingerprints(F.col("text"), [])["n_words"])
    # filtered after writing: a filter on a Python column would run it a second time, in a worker of its own
    sized = materialize(sized, "bench-items").filter("n > 0")
    # window lengths: `SPAN` and the lengths of shorter items, so at most SPAN values
    lengths = [r[0] for r in sized.select(F.least("n", F.lit(SPAN)).alias("n")).distinct().orderBy("n").collect()]
    parts = None
    for n in lengths:
        own = sized.filter(F.col("n") >= n) if n == SPAN else sized.filter(F.col("n") == n)
        got = own.select("item", F.explode(fingerprints(F.col("text"), [n])["found"]).alias("f"))
        parts = got if parts is None else parts.unionByName(got)
    if parts is None:
        parts = sized.select("item", F.lit(None).cast(_FOUND).alias("f"))
    marks = parts.select("item", "f.span", "f.hash", F.col("f.before").alias("i_before"), F.col("f.words").alias("i_words"))
    marks = materialize(marks.distinct(), "bench-marks", narrow=True)

    scanned = fingerprints(F.col(text), lengths, spark=spark, bits=_filter_bits(marks))
    rows = docs.select(F.col(id).alias("id"), scanned.alias("s"))
    rows = rows.select("id", "s.n_words", "s.found", F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows, "doc-marks")  # row numbers are fixed by writing them
    found = rows.select("row", F.explode("found").alias("f")).select("row", "f.*")
    # equal surroundings of many items, and equal fingerprints of many documents, meet as one
    around = marks.select("span", "hash", "i_before", "i_words").distinct()
    hits = found.join(around, ["span", "hash"]).withColumn("at", _reach()).filter("at.start is not null")
    hits = materialize(hits.select("row", "span", "hash", "i_before", "i_words", "at"), "doc-hits", narrow=True)
    words = hits.select("row", F.explode(F.expr("sequence(at.start, at.end - 1)")).alias("word")).distinct()
    n_hit = words.groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    which = hits.select("row", "span", "hash", "i_before", "i_words").distinct()
    which = which.join(marks, ["span", "hash", "i_before", "i_words"]).select("row", F.col("item").cast("string"))
    which = which.filter("item is not null").distinct().groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return (
        rows.select("row", "id", "n_words")
        .join(n_hit, "row", "left")
        .join(which, "row", "left")
        .select(
            F.col("id").alias(id),
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def clean_rows(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a hit word, with all their columns.

    Verdicts go by id and text together, so rows that share an id are judged each by its own text. Those of
    hit rows are written: while they are few, Spark broadcasts them by their size in files and no text moves.
    """
    digest = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    keyed = docs.select(F.struct(F.col(id).alias("id"), digest.alias("d")).alias("key"), F.col(text).alias("text"))
    dirty = find_hits(keyed, items, id="key").filter("n_hit > 0").select(F.col("key").alias("__dirty"))
    dirty = materialize(dirty.distinct(), "hit-keys", narrow=True)
    tagged = docs.withColumn("__key", F.struct(F.col(id).alias("id"), digest.alias("d")))
    return tagged.join(dirty, F.col("__key").eqNullSafe(F.col("__dirty")), "left_anti").drop("__key")
