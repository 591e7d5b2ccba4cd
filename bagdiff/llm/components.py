"""Connected components of a link table by alternating large-star and small-star rounds.

Each round rewires every link towards the smallest node its end points know, with
joins and partial aggregations only; links never meet in one task or the driver.
The smallest neighbours and the link table of each star are written to the shared
folder, so lineage stays short, and the join of both has no aggregate below it: a
small table is broadcast by its size in files, and of a large one adaptive execution
splits the task of a hub, however many links it has. Rounds grow with the logarithm of
the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagdiff.llm.common import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: (u, v) with v < u. One star round; the same form."""
    both = links.select("u", "v")
    if large:
        both = both.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = materialize(least.select("u", F.least("u", "m").alias("m")), "least", narrow=True)
    joined = both.join(least, "u")
    if large:  # neighbours above u point to the least of its neighbourhood
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # neighbours below u, and u itself, point to the least of them
        out = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each linked node and the smallest node it is connected to.

    ``a`` and ``b`` have one orderable type. Links with a null end, links of a node
    with itself and repeated links change nothing; an empty table gives an empty one.
    """
    links = links.filter(F.col(a) != F.col(b))
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links = materialize(links, "links", narrow=True)

    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first()

    before = state(links)
    while before[0]:
        links = materialize(_star(links, True), "links", narrow=True)
        links = materialize(_star(links, False), "links", narrow=True)
        after = state(links)
        if after == before:
            break
        before = after
    # every node but a smallest one now has exactly one link, to the smallest
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
