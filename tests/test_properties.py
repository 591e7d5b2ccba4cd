"""Properties of the comparison on the supplied documents table (sf0.001)."""

from pyspark.sql import functions as F

from bagdiff import compare, diff_lines
from bagdiff.plans import contract
from bagdiff.plans.pipelines import FILES, with_key

SF = "/root/testdata/sf0.001"


def _counts(df):
    return {r.bucket: r["count"] for r in df.groupBy("bucket").count().collect()}


def test_buckets_partition_each_side(spark):
    occ = contract.x_lines(spark, SF)
    res = compare(occ, FILES)
    c = _counts(res)
    sides = {r.side: r["count"] for r in occ.groupBy("side").count().collect()}
    assert c["comm_left"] == c["comm_right"]
    assert c["comm_left"] + c["diff_left"] == sides["left"]
    assert c["comm_right"] + c["diff_right"] == sides["right"]
    assert res.count() == occ.count()


def test_swap_sides_swaps_buckets(spark):
    occ = contract.x_lines(spark, SF)
    left, right = occ.where(F.col("side") == "left"), occ.where(F.col("side") == "right")
    flip = F.when(F.col("side") == "left", "right").otherwise("left")
    a = diff_lines(left, right)
    b = diff_lines(right.withColumn("side", flip), left.withColumn("side", flip))
    ca, cb = _counts(a), _counts(b)
    assert ca["diff_left"] == cb["diff_right"] and ca["diff_right"] == cb["diff_left"]
    assert ca["comm_left"] == cb["comm_right"]


def test_self_diff_is_all_common(spark):
    occ = contract.x_lines(spark, SF).where(F.col("side") == "left")
    res = diff_lines(occ, occ.withColumn("side", F.lit("right")))
    c = _counts(res)
    assert set(c) == {"comm_left", "comm_right"}


def test_diff_keys_are_except_all_and_comm_keys_intersect_all(spark):
    occ = with_key(contract.x_lines(spark, SF))
    res = compare(contract.x_lines(spark, SF), FILES)
    lk = occ.where(F.col("side") == "left").select("key")
    rk = occ.where(F.col("side") == "right").select("key")
    diff_keys = res.where(F.col("bucket") == "diff_left").select("key")
    comm_keys = res.where(F.col("bucket") == "comm_left").select("key")
    assert diff_keys.exceptAll(lk.exceptAll(rk)).count() == 0
    assert lk.exceptAll(rk).exceptAll(diff_keys).count() == 0
    inter = lk.intersectAll(rk)
    assert comm_keys.exceptAll(inter).count() == 0 and inter.exceptAll(comm_keys).count() == 0


def test_set_ops_with_tiny_chunks(spark):
    from bagdiff.operators.classify import except_all_keys, intersect_all_keys

    l = spark.createDataFrame([(k,) for k in ["a"] * 9 + ["b"] * 2 + ["c"]], "key string")
    r = spark.createDataFrame([(k,) for k in ["a"] * 4 + ["b"] * 3 + ["d"]], "key string")
    bag = l.withColumn("side", F.lit("left")).unionByName(r.withColumn("side", F.lit("right")))
    inter = sorted(x.key for x in intersect_all_keys(bag, chunk_bits=1).collect())
    exc = sorted(x.key for x in except_all_keys(bag, chunk_bits=1).collect())
    assert inter == ["a"] * 4 + ["b"] * 2
    assert exc == ["a"] * 5 + ["c"]
    assert sorted(x.key for x in l.intersectAll(r).collect()) == inter
    assert sorted(x.key for x in l.exceptAll(r).collect()) == exc


def test_empty_side_is_identity(spark):
    from conftest import occurrences

    from bagdiff.sources import empty_occurrences

    right = occurrences(spark, ["a", "b", "a"], "right")
    empty = empty_occurrences(spark).drop("key")
    res = diff_lines(empty, right).collect()
    assert sorted((r.bucket, r.line_no) for r in res) == [("diff_right", 1), ("diff_right", 2), ("diff_right", 3)]
    assert empty_occurrences(spark).unionByName(empty_occurrences(spark)).count() == 0


def test_repartition_by_key_hashes_on_key(spark):
    from bagdiff.operators import repartition_by_key

    occ = with_key(contract.x_lines(spark, SF))
    plan = repartition_by_key(occ, 16)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key" in plan and ", 16)" in plan


def test_line_numbers_do_not_depend_on_block_sizes(spark):
    from bagdiff.sources import lines_from_column

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    side = F.expr("CASE WHEN (doc_id div 20) % 2 = 0 THEN 'left' ELSE 'right' END")
    file = F.concat(F.col("source"), F.lit(".txt"))
    small = lines_from_column(docs, "text", side, file, "doc_id", block_bits=1, level_bits=13)
    default = lines_from_column(docs, "text", side, file, "doc_id")
    assert small.exceptAll(default).count() == 0 and default.exceptAll(small).count() == 0
    per_file = small.groupBy("side", "file").agg(F.count(F.lit(1)).alias("n"), F.max("line_no").alias("m"), F.min("line_no").alias("lo"))
    assert per_file.where((F.col("n") != F.col("m")) | (F.col("lo") != 1)).count() == 0


def test_sparse_order_values_are_numbered_in_bounded_windows(spark):
    """Hashed 64-bit ids, negative ones too: the same numbers as a window over the whole file, and no
    window of the plan over more than a group of ids."""
    from pyspark.sql import Window

    from bagdiff.sources import lines_from_column

    docs = spark.range(3000).select(F.xxhash64("id").alias("id"), F.concat_ws("\n", F.lit("a"), F.col("id")).alias("text"))
    lines = lines_from_column(docs, "text", F.lit("left"), F.lit("f"), "id")
    direct = docs.select("id", F.posexplode(F.split("text", "\n")).alias("p", "line"))
    numbers = F.row_number().over(Window.orderBy("id", "p")).cast("long")
    want = sorted(tuple(r) for r in direct.select(numbers.alias("line_no"), "line").collect())
    assert sorted((r.line_no, r.line) for r in lines.collect()) == want
    # groups of 2^18 blocks of 2^10 ids at each level: spread ids fall into many groups
    for shift in (10, 28, 46):
        inside = docs.groupBy(F.shiftright("id", shift + 18).alias("g")).agg(
            F.countDistinct(F.shiftright("id", shift)).alias("n")
        )
        assert inside.agg(F.max("n")).first()[0] <= 1 << 18


def test_lines_without_numbers_are_the_same_lines(spark):
    left = contract.x_bag(spark, SF).select("side", "file", "line", "key")
    right = with_key(contract.x_lines(spark, SF)).select("side", "file", "line", "key")
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0
