"""Phrase collocations through a weighted de Bruijn graph of the longest grams.

Texts are cut at ``.,;:!?`` and 0x0A-0x0D into pieces and these at spaces and tabs into words,
A-Z lower-cased, all per language (null: ``und``). f(phrase) counts its occurrences inside pieces.
Candidates are phrases of 2 to ``longest`` words with f of ``least`` or more. The score of a cut of a candidate into
two parts is ``floor(2000000 f / (f(first) + f(rest)))``; its lowest-scoring cut counts, the first of equal ones. A candidate is dropped
if it lies inside a longer one with 0.8 of its f or more.

1. *Links.* A phrase that occurs under ``least`` times lies in no candidate. One pass counts words and pairs of
   adjacent words in ``2 ** SKETCH_BITS`` buckets by hash; a bit for each bucket that reached ``least`` is
   broadcast. A second pass does so for three words whose pairs have their bits (up to
   ``longest - 1`` words). Other phrases in the same bucket only make more phrases pass, so no
   count depends on hashes; where all buckets are full, all pass.
2. *Edges.* Each word begins a gram: of its next words in the piece, up to ``longest``, as long as all phrases in them have their
   bits. The longest grams are the graph's edges, from the node of all their words but the last to that of all but
   the first, weighted with their number; the others are the corrections for the ends of pieces, as a piece also
   ends where no longer phrase can be frequent.
3. *Node flow.* f of a node is the weight of the edges that leave it and its correction; f of a shorter phrase is the sum over the phrases of one
   word more that begin with it, and its correction.
4. *Paths.* A node with one edge in and one out, where no piece begins or ends, is unary. Edges that meet in
   unary nodes become one path, by pointer doubling. A unary node has the f of its path's grams, so it is dropped
   without a look at any table, and its f needs no join.

Defined results: null text reads as empty. Documents are counted one by one, whatever their id. Texts of any length are
cut whole. An empty table gives no row. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bagdiff.llm.common import attach_by_key, bound_batches, chunks, materialize, tidy

UNKNOWN = "und"
ENDS = ".,;:!?\n\x0b\x0c\r"
#: 8 MB of bits to broadcast for each size of phrases, from two words to one under the longest.
SKETCH_BITS = 26
BLOCK_BITS = 16
#: Characters that a task cuts into words at once, and bucket numbers that it holds.
TOGETHER = 3_000_000
HELD = 6_000_000
#: A byte that no UTF-8 text holds stands between pieces.
_END = b"\xff"
_CUTS = bytes.maketrans(ENDS.encode() + b"\t", _END * len(ENDS) + b" ")
_CUTS_AND_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in _CUTS)


class _Words:
    """The words of some texts of one language as numbers from 1; 0 ends a piece."""

    def __init__(self, lang: str, texts: list[str]):
        import numpy as np
        import xxhash

        data = _END.join([t.encode().translate(_CUTS_AND_LOWER) for t in texts])
        held = data.replace(_END, b" " + _END + b" ").split(b" ")
        numbers = {_END: 0}
        ids = [numbers.setdefault(w, len(numbers)) for w in held if w]
        self.ids = np.array([*ids, 0], np.int64)
        self.words = list(numbers)
        seed = xxhash.xxh64_intdigest(lang.encode())
        self.hashes = np.array([xxhash.xxh64_intdigest(w, seed) for w in self.words], np.uint64)
        self.total = int((self.ids > 0).sum())

    def buckets(self, longest: int):
        """For 1 to ``longest`` words the bucket of each place's phrase of so many words, whatever ends within it."""
        import numpy as np

        word = self.hashes[self.ids]
        phrase, shift = word, np.uint64(64 - SKETCH_BITS)
        yield word >> shift
        for size in range(1, longest):
            phrase = phrase * np.uint64(0x9E3779B97F4A7C15) + np.append(word[size:], np.zeros(size, np.uint64))[: len(word)]
            phrase ^= phrase >> np.uint64(29)
            phrase *= np.uint64(0xBF58476D1CE4E5B9)
            yield phrase >> shift

    def frequent(self, sketches):
        """For each place, whether its word, its next two words, ... may be frequent, by the bits of ``sketches``.

        The first of them has the bits of words and of pairs, the next those of three words, and so on.
        One size more than they have is told by the two phrases in it.
        """
        import numpy as np

        def known(sketch, buckets):
            buckets = buckets.astype(np.int64)
            return (sketch[buckets >> 3] >> (7 - (buckets & 7)).astype(np.uint8)) & 1 > 0

        inside = self.ids > 0
        goes_on, out = inside, []
        for size, buckets in enumerate(self.buckets(len(sketches) + 1), 1):
            if size > 1:
                goes_on = goes_on & np.append(goes_on[1:], False)
            here = goes_on & known(sketches[max(0, size - 2)], buckets)
            out.append(here)
            goes_on = here if size > 1 else inside  # a pair's bit tells more than its words'
        return [*out, goes_on & np.append(goes_on[1:], False)]


def _by_language(batch, together: int):
    """(language, texts) of an Arrow batch of languages and texts, ``together`` characters at a time."""
    for start in range(0, batch.num_rows, 4096):
        part = batch.slice(start, 4096)
        langs, at = part.column(0).to_pylist(), 0
        held: dict[str, list[str]] = {}
        size = 0
        for _, texts in chunks(part.column(1)):
            for text in texts:
                held.setdefault(langs[at], []).append(text)
                at, size = at + 1, size + len(text)
            if size > together:
                yield from held.items()
                held, size = {}, 0
        yield from held.items()


def _sketch(docs: DataFrame, least: int, before) -> DataFrame:
    """``block, bits`` of the buckets that reached ``least``: 8 KB for each of ``2 ** (SKETCH_BITS - BLOCK_BITS)`` blocks.

    ``before`` is a broadcast list of the bits for fewer words; without any, words and pairs are counted.
    """
    size = 1 << BLOCK_BITS

    def counted(batches):
        import numpy as np
        import pyarrow as pa

        held, n = [], 0
        sketches = [np.frombuffer(x, np.uint8) for x in before.value]

        def packed(buckets, *more):
            """block -> bytes of its buckets and of more about each."""
            blocks = buckets >> BLOCK_BITS
            cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            columns = [(buckets & (size - 1)).astype("<u2"), *more]
            return {int(blocks[a]): [c[a:b].tobytes() for c in columns] for a, b in zip(cuts, cuts[1:], strict=False) if b > a}

        def rows():
            buckets, counts = np.unique(np.concatenate(held), return_counts=True)
            # most buckets come once in a task and need no count
            once, more = packed(buckets[counts == 1]), counts > 1
            often = packed(buckets[more], np.minimum(counts[more], 255).astype(np.uint8))
            blocks = sorted(once.keys() | often.keys())
            data = [
                pa.array(blocks, pa.int32()),
                pa.array([once.get(b, [b""])[0] for b in blocks], pa.binary()),
                pa.array([often.get(b, [b"", b""])[0] for b in blocks], pa.binary()),
                pa.array([often.get(b, [b"", b""])[1] for b in blocks], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(data, names=["block", "once", "often", "counts"])

        for batch in batches:
            for lang, texts in _by_language(batch, TOGETHER):
                words = _Words(lang, texts)
                if sketches:
                    counts = [(words.frequent(sketches)[-1], list(words.buckets(len(sketches) + 2))[-1])]
                else:
                    inside, (one, two) = words.ids > 0, words.buckets(2)
                    counts = [(inside, one), (inside & np.append(inside[1:], False), two)]
                for where, buckets in counts:
                    held.append(buckets[where].astype(np.uint32))
                    n += len(held[-1])
                if n > HELD:
                    yield rows()
                    held, n = [], 0
        if n:
            yield rows()

    def full(batches):
        import numpy as np
        import pyarrow as pa

        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, once, often, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = sums.setdefault(block, np.zeros(size, np.uint8))
                for held, n in ((once, np.uint8(1)), (often, np.frombuffer(counts, np.uint8))):
                    at = np.frombuffer(held, "<u2")
                    own[at] = np.minimum(own[at].astype(np.uint16) + n, 255)
        bits = [np.packbits(x >= least).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(bits, pa.binary())], names=["block", "bits"])

    found = docs.mapInArrow(tidy(counted), "block int, once binary, often binary, counts binary")
    return found.repartition("block").mapInArrow(tidy(full), "block int, bits binary")


def _grams(docs: DataFrame, bits, longest: int) -> DataFrame:
    """``lang, size, gram, n``: the grams that words begin with their numbers; of size 0 the number of all words.

    ``bits`` is the broadcast list of the bits for two to ``longest - 1`` words.
    """

    def found(batches):
        import numpy as np
        import pyarrow as pa

        sketches = [np.frombuffer(x, np.uint8) for x in bits.value]

        def distinct(columns):
            """Distinct rows of number columns, and how often each comes."""
            if max(int(c.max()) for c in columns) < 1 << 16 and len(columns) <= 4:
                keys = sum((c.astype(np.uint64) << np.uint64(16 * i) for i, c in enumerate(columns)), np.uint64(0))
                keys, counts = np.unique(keys, return_counts=True)
                return [(keys >> np.uint64(16 * i) & np.uint64(0xFFFF)).tolist() for i in range(len(columns))], counts
            rows, counts = np.unique(np.stack(columns, axis=1), axis=0, return_counts=True)
            return [rows[:, i].tolist() for i in range(len(columns))], counts

        def rows(lang, size, grams, counts):
            n = len(grams)
            data = [pa.array([lang] * n, pa.string()), pa.array([size] * n, pa.int32()), pa.array(grams, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())]
            return pa.RecordBatch.from_arrays(data, names=["lang", "size", "gram", "n"])

        for batch in batches:
            for lang, texts in _by_language(batch, TOGETHER):
                words = _Words(lang, texts)
                ids = words.ids
                word, *longer = words.frequent(sketches)
                # a word that is nowhere linked matters to no candidate
                lengths = (word | longer[0]).astype(np.int64) + sum(x.astype(np.int64) for x in longer)
                yield rows(lang, 0, [b""], [words.total])
                for size in range(1, longest + 1):
                    places = np.flatnonzero(lengths == size)
                    if len(places):
                        columns, counts = distinct([ids[places + i] for i in range(size)])
                        spelled = [list(map(words.words.__getitem__, c)) for c in columns]
                        yield rows(lang, size, [b" ".join(g) for g in zip(*spelled, strict=True)], counts)

    made = docs.mapInArrow(tidy(found), "lang string, size int, gram string, n bigint")
    return made.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


def _first(gram: Column, words: int | Column) -> Column:
    return F.call_function("substring_index", gram, F.lit(" "), words if isinstance(words, Column) else F.lit(words))


def _flows(grams: DataFrame, longest: int) -> list[DataFrame]:
    """``lang, gram, f`` of the phrases of 1 to ``longest`` words; nodes also have ``unary``."""
    levels = [grams.where(F.col("size") == longest).select("lang", "gram", F.col("n").alias("f"))]
    for size in range(longest - 1, 0, -1):
        longer = levels[0]
        corrections = grams.where(F.col("size") == size).select("lang", "gram", F.col("n").alias("f"))
        if size == longest - 1:
            no, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
            leaving = longer.select("lang", _first(F.col("gram"), size).alias("gram"), "f", no.alias("in"), one.alias("outs"), no.alias("ins"))
            entering = longer.select("lang", _first(F.col("gram"), -size).alias("gram"), no.alias("f"), F.col("f").alias("in"), no.alias("outs"), one.alias("ins"))
            ending = corrections.select("lang", "gram", "f", no.alias("in"), F.lit(2).cast("bigint").alias("outs"), no.alias("ins"))
            nodes = leaving.unionByName(entering).unionByName(ending).groupBy("lang", "gram")
            nodes = nodes.agg(*[F.sum(c).alias(c) for c in ("f", "in", "outs", "ins")])
            unary = (F.col("outs") == 1) & (F.col("ins") == 1) & (F.col("in") == F.col("f"))
            # nodes that are only entered end no gram of theirs here: f would be 0, but for their corrections
            level = nodes.select("lang", "gram", "f", unary.alias("unary"))
        else:
            begins = longer.select("lang", _first(F.col("gram"), size).alias("gram"), "f")
            level = begins.unionByName(corrections).groupBy("lang", "gram").agg(F.sum("f").alias("f"))
        levels.insert(0, materialize(level, f"phrases_{size}", narrow=True))
    return levels


def _paths(edges: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """``lang, words, f``: edges that meet in unary nodes joined to paths; any other edge is a path by itself.

    The edge before an edge is known where its first node is unary. Each round an edge learns of the one twice
    as far before it, so a path of m edges takes log2(m) rounds; a path is never longer than a piece.
    """
    size = longest - 1
    unary = nodes.where(F.col("unary")).select("lang", F.col("gram").alias("node"))
    ends = edges.select("lang", _first(F.col("gram"), -size).alias("node"), F.col("gram").alias("before"))
    inner = ends.join(unary, ["lang", "node"])
    state = edges.withColumn("node", _first(F.col("gram"), size)).join(inner, ["lang", "node"], "left")
    state = state.select("lang", "gram", "f", F.coalesce("before", "gram").alias("first"), F.when(F.col("before").isNull(), 0).otherwise(1).cast("bigint").alias("far"))
    state = materialize(state, "phrase_paths", narrow=True)
    while True:
        up = state.where(F.col("far") > 0).select("lang", F.col("gram").alias("first"), F.col("first").alias("__first"), F.col("far").alias("__far"))
        moving = state.where(F.col("far") > 0)
        if moving.join(up.select("lang", "first"), ["lang", "first"], "left_semi").isEmpty():
            break
        state = state.join(up, ["lang", "first"], "left").select(
            "lang", "gram", "f", F.coalesce("__first", "first").alias("first"), (F.col("far") + F.coalesce("__far", F.lit(0))).alias("far")
        )
        state = materialize(state, "phrase_paths", narrow=True)
    steps = F.sort_array(F.collect_list(F.struct("far", _first(F.col("gram"), -1).alias("last"))))
    paths = state.groupBy("lang", "first").agg(steps.alias("steps"), F.max("f").alias("f"))
    later = F.transform(F.slice("steps", 2, F.greatest(F.size("steps") - 1, F.lit(0))), lambda s: s["last"])
    return paths.select("lang", F.concat(F.split("first", " "), later).alias("words"), "f")


def cut_score(f: Column, first: Column, rest: Column) -> Column:
    """``floor(2000000 f / (first + rest))``, exact: the product may pass 64 bits."""
    wide = [c.cast("decimal(20,0)") for c in (f, first, rest)]
    return F.call_function("div", wide[0] * F.lit(2_000_000).cast("decimal(7,0)"), wide[1] + wide[2])


def mine(df: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, longest: int = 4, top: int = 2000) -> DataFrame:
    """The first ``top`` candidates of each language by score, f (both descending) and phrase; ``longest`` is 3 or more.

    Returns ``lang, rank, phrase, a, l, r, n, score``: ``a`` is f of the phrase, ``l`` and ``r`` those of the parts of its
    lowest-scoring cut, ``n`` the number of all words of the language.
    """
    if longest < 3:
        raise ValueError("nodes of the graph need two words or more")
    spark = df.sparkSession
    bound_batches(spark)
    docs = df.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    sketches: list[bytes] = []
    width = 1 << (BLOCK_BITS - 3)
    for _ in range(2, longest):
        flags = bytearray(1 << (SKETCH_BITS - 3))
        for block, bits in _sketch(docs, least, spark.sparkContext.broadcast(sketches)).toLocalIterator():
            flags[block * width : (block + 1) * width] = bits
        sketches = [*sketches, bytes(flags)]
    grams = materialize(_grams(docs, spark.sparkContext.broadcast(sketches), longest), "phrase_grams", narrow=True)
    levels = [x.where(F.col("f") >= least) for x in _flows(grams, longest)]
    paths = materialize(_paths(levels[-1], levels[-2], longest), "phrase_compact", narrow=True)

    # windows of a path: its first and last node are the only ones that other edges may share
    at, size = F.col("at"), F.size("words")
    windows = paths.select("lang", "words", "f", F.explode(F.sequence(F.lit(1), size - longest + 1)).alias("at"))
    whole = windows.select(
        "lang", F.slice("words", at, longest).alias("words"), "f", (at > 1).alias("in_head"), (at < size - longest + 1).alias("in_tail")
    )
    no = F.lit(False)
    shorter = [x.where(~F.col("unary")) if "unary" in x.columns else x for x in levels[1:-1]]
    shorter = [x.select("lang", F.split("gram", " ").alias("words"), "f", no.alias("in_head"), no.alias("in_tail")) for x in shorter]
    candidates = whole
    for x in shorter:
        candidates = candidates.unionByName(x)
    candidates = candidates.select("lang", F.array_join("words", " ").alias("phrase"), "words", "f", "in_head", "in_tail")
    candidates = materialize(candidates, "phrase_candidates", narrow=True)
    return _ranked(_scored(_undropped(candidates, longest), levels[:-1], longest), grams, top)


def _undropped(candidates: DataFrame, longest: int) -> DataFrame:
    """Candidates that lie in no longer one with 0.8 of their f."""
    n = F.size("words")
    # (start, size) of all proper parts of two words or more; unary nodes are no candidates any more
    spans = F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda s: F.struct(s.alias("s"), k.alias("k")))))
    inside = candidates.where(n > 2).select("lang", "words", "f", "in_head", "in_tail", F.explode(spans).alias("span"))
    node = F.col("span.k") == longest - 1
    own = ~(node & F.when(F.col("span.s") == 1, F.col("in_head")).otherwise(F.col("in_tail")))
    parts = inside.where(own | (n < longest)).select("lang", F.array_join(F.slice("words", F.col("span.s"), F.col("span.k")), " ").alias("phrase"), "f")
    cover = parts.groupBy("lang", "phrase").agg(F.max("f").alias("cover"))
    found = candidates.join(cover, ["lang", "phrase"], "left")
    wide = [F.col(c).cast("decimal(20,0)") for c in ("cover", "f")]
    return found.where(F.col("cover").isNull() | (wide[0] * 100 < wide[1] * 80)).drop("cover")


def _scored(candidates: DataFrame, levels: list[DataFrame], longest: int) -> DataFrame:
    """``lang, phrase, a, l, r, score`` by the lowest-scoring cut."""

    def key(phrase) -> Column:  # no phrase holds a line feed
        return F.concat("lang", F.lit("\n"), phrase)

    known = levels[0].select("lang", "gram", "f")
    for level in levels[1:]:
        known = known.unionByName(level.select("lang", "gram", "f"))
    known = known.select(key("gram").alias("part"), F.col("f").alias("part_f"))
    total = known.agg(F.sum("part_f")).first()[0] or 0
    cuts = candidates.select("lang", "phrase", F.size("words").alias("n"), "f", "in_head", "in_tail", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("cut"))
    sides = F.array(
        F.struct(F.lit(1).alias("side"), _first(F.col("phrase"), F.col("cut")).alias("text"), (F.col("in_head") & (F.col("cut") == F.col("n") - 1)).alias("unary")),
        F.struct(F.lit(2).alias("side"), _first(F.col("phrase"), F.col("cut") - F.col("n")).alias("text"), (F.col("in_tail") & (F.col("cut") == 1)).alias("unary")),
    )
    asked = cuts.select("lang", "phrase", "f", "cut", F.explode(sides).alias("half"))
    asked = asked.select("lang", "phrase", "f", "cut", "half.side", F.when(~F.col("half.unary"), key("half.text")).alias("part"))
    inner = asked.where(F.col("part").isNull()).withColumn("part_f", F.col("f"))  # unary nodes have their path's f
    met = attach_by_key(asked.where(F.col("part").isNotNull()), known, "part", "part_f", total).unionByName(inner)
    halves = [F.max(F.when(F.col("side") == s, F.col("part_f"))).alias(c) for s, c in ((1, "l"), (2, "r"))]
    both = met.groupBy("lang", "phrase", "f", "cut").agg(*halves)
    both = both.withColumn("score", cut_score(F.col("f"), F.col("l"), F.col("r")).cast("bigint"))
    best = both.groupBy("lang", "phrase", "f").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    return best.select("lang", "phrase", F.col("f").alias("a"), "best.l", "best.r", "best.score")


def _ranked(scored: DataFrame, grams: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = scored.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    totals = grams.where(F.col("size") == 0).select("lang", "n")
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
