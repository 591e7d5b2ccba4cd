"""The four flag combinations and needle semantics."""

import pytest
from conftest import emulate, occurrences

from bagdiff import diff_lines

LEFT = ["Hello World", "hello  world", "HELLO WORLD", "x\ty", "the end", "The End"]
RIGHT = ["helloworld", "Hello World", "x\tY", "theend"]


@pytest.mark.parametrize("space_sensitive", [False, True])
@pytest.mark.parametrize("case_sensitive", [False, True])
def test_flags(spark, space_sensitive, case_sensitive):
    res = diff_lines(
        occurrences(spark, LEFT, "left"),
        occurrences(spark, RIGHT, "right"),
        space_sensitive=space_sensitive,
        case_sensitive=case_sensitive,
    )
    got = {(r.side, r.line_no): r.bucket for r in res.select("side", "line_no", "bucket").collect()}
    assert got == emulate(LEFT, RIGHT, space_sensitive, case_sensitive)[0]


def test_raw_needle_against_normalised_key(spark):
    l, r = occurrences(spark, LEFT, "left"), occurrences(spark, RIGHT, "right")
    # the needle is not normalised: capitals or spaces never match a default key
    assert diff_lines(l, r, needle="The").count() == 0
    assert diff_lines(l, r, needle="the e").count() == 0
    got = {(x.side, x.line_no) for x in diff_lines(l, r, needle="the").collect()}
    assert got == {("left", 5), ("left", 6), ("right", 4)}
    # opt-in: normalise the needle like the keys
    assert diff_lines(l, r, needle="The E", normalize_needle=True).count() == 3


def test_tabs_are_not_spaces(spark):
    res = diff_lines(occurrences(spark, ["x\ty"], "left"), occurrences(spark, ["xy"], "right")).collect()
    assert {r.bucket for r in res} == {"diff_left", "diff_right"}
