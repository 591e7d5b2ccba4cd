"""SimHash near-duplicates through an inverted index over byte positions.

*Fingerprint.* Words are runs of anything but space and 0x09-0x0D, A-Z
lower-cased; shingles are ``shingle`` consecutive words (repeats included) joined
by a space, the whole sequence if it is shorter. Bit i is 1 when over half of the
shingles' XXH64 (UTF-8, seed 42) have it. No words: fingerprint zero.

*Index.* ``distance`` differing bits touch at most that many of the eight bytes, so
linked fingerprints agree in at least ``8 - distance`` (byte, position) pairs: the
guaranteed minimum. A list per single (byte, position) would hold 1/256 of all
fingerprints and cost their square, so a list is kept per combination of
``INDEX_BYTES`` positional bytes, for a family of combinations that meets every
possible set of the minimum's size (20 to 24 lists for a distance of 4). Each pair that
meets in a list is tallied by its shared positional bytes, retained at the minimum
or more, and verified on its bits.

*Hot lists.* A list of over ``LIST_MAX`` fingerprints would make too many pairs.
Its members are instead listed under every value within half the distance: two
values differ in at most ``distance`` bits exactly if such a middle value exists,
so all members of one of these lists are linked, and linking each to the smallest
gives the same components. A middle value's list is bounded (2,081 for distance 4).

Equal fingerprints are one node. Components of the links are found by star rounds.

Defined results: null text reads as empty. The component id is the smallest id
reachable; null ids count only where there is no other. Repeated rows give repeated
results. Other columns are ignored; ``one_of_each`` keeps them, and one row of each component.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagdiff.llm.common import arrow_column, attach_by_key, chunks, materialize, one_each
from bagdiff.llm.components import components

SEED = 42
LIST_MAX = 64
#: Positional bytes in a list's key; four for over about 10^8 distinct fingerprints.
INDEX_BYTES = 3
#: Shingle hashes that are expanded to bits at once.
BLOCK = 32_768


def _fingerprint(text: str, shingle: int) -> int:
    """Signed 64-bit fingerprint of one whole text."""
    import numpy as np
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    hash64 = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), max(1, len(words) - shingle + 1)
    for s in range(0, n, BLOCK):
        part = words[s : s + BLOCK + shingle - 1]
        line = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        m = max(1, len(part) - shingle + 1)
        last = ends[shingle - 1 :] if len(part) >= shingle else ends[-1:]
        hashes = [hash64(line[a:b], SEED) for a, b in zip(starts[:m].tolist(), last.tolist(), strict=True)]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big", signed=True)


def fingerprint(text: Column, shingle: int = 4) -> Column:
    """Fingerprint of a text column as a bigint."""

    def run(batches):
        import pyarrow as pa

        for texts in batches:
            yield pa.array([_fingerprint(t, shingle) for _, part in chunks(texts) for t in part], pa.int64())

    return arrow_column(run, "bigint", text)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def index_combinations(matches: int, size: int) -> list[tuple[int, ...]]:
    """Combinations of ``size`` of the eight byte positions, at least one inside every set of ``matches`` positions.

    Chosen greedily: each next one lies in the most sets that have none yet.
    """
    left = [set(x) for x in combinations(range(8), matches)]
    pool, chosen = list(combinations(range(8), min(size, matches))), []
    while left:
        best = max(pool, key=lambda c: sum(set(c) <= x for x in left))
        chosen.append(best)
        left = [x for x in left if not set(best) <= x]
    return chosen


def _lists(distance: int, index_bytes: int) -> Column:
    """The keys of the lists of ``fp``: it with all bytes outside a combination set to zero."""
    chosen = index_combinations(8 - distance, index_bytes)
    masks = [_signed(sum(0xFF << 8 * i for i in at)) for at in chosen]
    return F.array_distinct(F.transform(F.array(*[F.lit(m) for m in masks]), lambda m: m.bitwiseAND(F.col("fp"))))


def _shared_bytes(x: Column) -> Column:
    """How many of the eight bytes of an exclusive or are zero."""
    zero = [F.when(x.bitwiseAND(_signed(0xFF << 8 * i)) == 0, 1).otherwise(0) for i in range(8)]
    return sum(zero[1:], zero[0])


def _middles(radius: int) -> Column:
    """Every value that differs from ``fp`` in at most ``radius`` bits."""
    flips = [0] + [sum(1 << i for i in at) for r in range(1, radius + 1) for at in combinations(range(64), r)]
    return F.transform(F.array(*[F.lit(_signed(x)) for x in flips]), lambda x: F.col("fp").bitwiseXOR(x))


def links(
    fps: DataFrame, distance: int = 4, list_max: int = LIST_MAX, index_bytes: int = INDEX_BYTES
) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fp``, complete up to connectedness.

    Pairs of lists of at most ``list_max`` are all there; in larger lists each
    member is linked to the smallest of each of its middle values.
    """
    if not 0 <= distance <= 7:
        raise ValueError("distance must be from 0 to 7")
    lists = fps.select("fp", F.explode(_lists(distance, index_bytes)).alias("key"))
    sizes = lists.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    sizes = materialize(sizes.filter("n > 1"), "simhash-lists", narrow=True)
    pairs = sizes.filter("n = 2").select("a", "b")
    members = lists.join(sizes.filter("n > 2").select("key", "n"), "key")
    members = materialize(members, "simhash-members", narrow=True)
    cold = members.filter(F.col("n") <= list_max).select("key", "fp")
    pairs = pairs.unionByName(
        cold.withColumnRenamed("fp", "a").join(cold.withColumnRenamed("fp", "b"), "key").filter("a < b").select("a", "b")
    )
    differing = F.col("a").bitwiseXOR(F.col("b"))
    tallied = pairs.withColumn("shared", _shared_bytes(differing)).filter(F.col("shared") >= 8 - distance)
    found = tallied.filter(F.bit_count(differing) <= distance).select("a", "b")
    hot = members.filter(F.col("n") > list_max).select("fp").distinct()
    if hot.isEmpty():
        return found.distinct()
    near = _starred(hot.select("fp", F.explode(_middles(distance // 2)).alias("middle")))
    if distance % 2:
        near = near.unionByName(_one_further(hot, distance // 2))
    return found.unionByName(near).distinct()


def _starred(listed: DataFrame) -> DataFrame:
    """Links of each member of a middle value's list to the smallest; the lists are bounded."""
    from pyspark.sql import Window

    least = F.min("fp").over(Window.partitionBy("middle"))
    return listed.withColumn("a", least).filter("a < fp").select("a", F.col("fp").alias("b"))


def _one_further(hot: DataFrame, radius: int) -> DataFrame:
    """For distance 2 * radius + 1: each value linked to the smallest of every middle value one flip beyond its own.

    The rest of that list is linked to its smallest already, and the smallest is within the distance.
    """
    listed = hot.select("fp", F.explode(_middles(radius)).alias("middle"))
    flips = F.array(*[F.lit(_signed(1 << i)) for i in range(64)])
    beyond = listed.select(
        F.col("fp").alias("a"), F.explode(F.transform(flips, lambda x: F.col("middle").bitwiseXOR(x))).alias("middle")
    )
    least = listed.groupBy("middle").agg(F.min("fp").alias("b"))
    return beyond.join(least, "middle").filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _grouped(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = 4,
    distance: int = 4,
    list_max: int = LIST_MAX,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """One row per row of ``df``: ``id``, fp (bigint), component (its smallest fp), component_id."""
    rows = df.select(F.col(id).alias("id"), fingerprint(F.col(text), shingle).alias("fp"))
    rows = materialize(rows, "simhash-rows")
    nodes = rows.groupBy("fp").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    nodes = materialize(nodes, "simhash-nodes", narrow=True)
    joined = components(links(nodes.select("fp"), distance, list_max, index_bytes)).select(
        F.col("node").alias("fp"), "component"
    )
    nodes = nodes.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    nodes = materialize(nodes, "simhash-components", narrow=True)
    # written before the join, so that adaptive execution can split a component with very many fingerprints
    smallest = nodes.groupBy("component").agg(F.min("id").alias("component_id"))
    smallest = materialize(smallest, "simhash-smallest", narrow=True)
    groups = materialize(nodes.join(smallest, "component").select("fp", "component", "component_id", "n"), "simhash-groups", narrow=True)
    total = groups.agg(F.sum("n")).first()[0] or 0
    found = attach_by_key(rows, groups, "fp", "n", total)
    return found.select(F.col("id").alias(id), "fp", "component", "component_id")


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``df``: ``id``, fp (bigint), component_id."""
    return _grouped(df, id, text, **options).drop("component")


def one_of_each(df: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, **options) -> DataFrame:
    """Exactly one row of ``df`` for each component, with all its columns: one with the component's id.

    Of several with this id, the smallest fingerprint's. The ids that go are written and taken
    out of ``df`` by an anti-join: while they are few, Spark broadcasts them by their size in files
    and no text moves. Rows that share an id are told apart by their fingerprints.
    """
    found = _grouped(df, id, text, shingle, **options).withColumnRenamed(id, "__id")
    own = F.col("__id").eqNullSafe(F.col("component_id"))
    ids = found.groupBy("__id").agg(F.count(F.lit(1)).alias("__n"), F.max(own).alias("__own"))
    gone = materialize(ids.filter("__n > 1 or not __own"), "simhash-gone", narrow=True)
    same = F.col(id).eqNullSafe(F.col("__id"))
    out = df.join(gone, same, "left_anti")
    repeated = gone.filter("__n > 1 and __own")
    if repeated.isEmpty():
        return out
    shared = repeated.select(F.col("__id").alias("__any"))
    kept = found.filter(own).join(shared, F.col("__id").eqNullSafe(F.col("__any")), "left_semi")
    kept = kept.groupBy("component").agg(F.first("__id").alias("__id"), F.min("fp").alias("__fp"))
    kept = materialize(kept.select("__id", "__fp"), "simhash-kept", narrow=True)
    rows = df.join(repeated, same, "left_semi").withColumn("__f", fingerprint(F.col(text), shingle))
    rows = rows.join(kept, same & (F.col("__f") == F.col("__fp")), "left_semi")
    return out.unionByName(one_each(rows, [id, "__f"]).drop("__f"))
