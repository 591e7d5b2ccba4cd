"""Plan shape: nothing runs in a single partition, nothing pairs all rows, the
scan is pruned and filtered."""

import re

import pytest

import __spark_entry__ as E
from bagdiff.plans import contract
from bagdiff.plans.pipelines import FILES, compare

SF = "/root/testdata/sf0.001"
HEADLINE = ["diff_files", "diff_dirs", "diff_pooled_dirs", "sorted_buckets", "intersect_all_keys", "render_groups"]


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString() + "\n" + df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", HEADLINE)
def test_no_single_partition_or_cartesian(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for bad in ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, bad


def test_scan_is_pruned_and_filtered(spark):
    df = E.queries()["diff_files"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(text)" in plan
    for unused in ("n_chars", "lang", "source"):
        assert f"{unused}:" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_listing_reads_no_text(spark):
    df = E.queries()["file_list"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "doc_id" in schema and "text:string" not in schema


def _final(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("Final Plan")[1].split("Initial Plan")[0] if "Final Plan" in plan else plan


READ_ONCE = sorted(n for n in contract.queries() if not n.startswith(("text_", "written_")))


@pytest.mark.parametrize("name", READ_ONCE)
def test_document_text_is_read_once(spark, name):
    """Numbering, counting and ranking share one exchange of the document text."""
    scans = [x for x in _final(E.queries()[name](spark, SF)).split("\n") if "FileScan parquet" in x and re.search(r"\btext\b", x)]
    assert len(scans) <= 1, scans


@pytest.mark.parametrize("name", ["text_lines", "text_bag", "text_diff_files", "text_diff_dirs", "text_diff_pooled"])
def test_text_files_are_read_once_a_side(spark, name):
    scans = [x for x in _final(E.queries()[name](spark, SF)).split("\n") if "FileScan text" in x]
    assert len(scans) == 2, scans


@pytest.mark.parametrize("name", ["diff_files", "diff_dirs", "diff_pooled_dirs", "text_diff_files"])
def test_one_exchange_carries_lines(spark, name):
    """Lines move once to their keys; keys do not move; the chunked way is gone when no key is heavy."""
    final = _final(E.queries()[name](spark, SF))
    moved = [x for x in final.split("\n") if re.search(r"\bExchange hashpartitioning", x) and "ReusedExchange" not in x]
    with_line = [x for x in moved if "lower(replace(line" in x]
    assert len(with_line) == 1, moved
    assert not [x for x in moved if re.search(r"hashpartitioning\((file#\d+, )?key", x)]
    assert "Union" not in final.split("Window")[0]


def test_no_heavy_key_costs_nothing(spark):
    """Without heavy keys the plan is that of heavy_rows=None: one exchange for ranking, no join or aggregate for parts."""
    res = {}
    for heavy_rows in (1 << 20, None):
        lines = contract.x_lines(spark, SF)
        df = compare(lines, FILES, heavy_rows=heavy_rows)
        plan = _final(df)
        res[heavy_rows] = [re.sub(r"#\d+L?|plan_id=\d+|\d+", "", x).strip(" :+-*()") for x in plan.split("\n") if not re.search("FileScan|Location", x)]
    assert res[1 << 20] == res[None]
    assert sum("Exchange" in x and "Reused" not in x for x in res[None]) == sum("Exchange" in x and "Reused" not in x for x in res[1 << 20])


@pytest.mark.parametrize("name", ["bag_union", "key_counts", "pooled_scan", "output_names", "intersect_all_keys", "except_all_keys"])
def test_no_numbering_where_none_is_used(spark, name):
    assert "Window" not in _final(E.queries()[name](spark, SF))
