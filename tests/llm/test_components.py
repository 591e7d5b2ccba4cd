from __future__ import annotations

import random

from bagdiff.llm.components import _star, components


def reach(links):
    near = {}
    for a, b in links:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    out = {}
    for start in sorted(near):
        if start in out:
            continue
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = start
                todo += near[x]
    return out


def check(spark, links, kind="long"):
    df = spark.createDataFrame(links, f"a {kind}, b {kind}")
    rows = components(df).collect()
    found = {r.node: r.component for r in rows}
    assert len(found) == len(rows)
    assert found == reach(links)


def test_random_graphs(spark):
    rnd = random.Random(5)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)]
    check(spark, [*links, (None, 3), (4, None), (7, 7), links[0]])


def test_chain_star_and_strings(spark):
    order = list(range(80))
    random.Random(2).shuffle(order)
    chain = list(zip(order, order[1:], strict=False))
    star = [(1000, 2000 + i) for i in range(60)]
    check(spark, [(f"n{a:05}", f"n{b:05}") for a, b in chain + star], "string")


def test_no_links(spark):
    check(spark, [])


def test_a_hub_is_split(spark):
    """A hub's links, and the leaves of a two-level star, are joined by many tasks."""
    leaves = 100_000
    links = spark.sql(f"SELECT id + 1 AS u, 0L AS v FROM range({leaves}) UNION ALL SELECT id + {leaves + 1}, 1L FROM range(500)")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    }
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = _star(links, True)
        assert {r.v for r in out.collect()} == {0}
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString().replace("isSkew", "skew")
        found = components(links.withColumnsRenamed({"u": "a", "v": "b"}))
        assert found.filter("component <> 0").count() == 0 and found.count() == leaves + 501
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
