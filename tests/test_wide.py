"""UTF-16 and UTF-32 files: cuts that are not aligned are joined where they are read, nothing but border pieces moves."""

import random

import pytest

from bagdiff.sources import read_sides

PAIR = "\u0a05\u0100"  # its bytes hold a line feed's in UTF-16LE


@pytest.fixture
def conf(spark):
    """Sets session settings until the test ends."""
    old = {}

    def put(key, value):
        old.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    yield put
    for key, value in old.items():
        spark.conf.set(key, value)


def _exchanged(plan) -> int:
    """Rows that the shuffles of an executed plan moved."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return _exchanged(plan.executedPlan())
    if name.endswith("QueryStage"):
        return _exchanged(plan.plan())
    own = plan.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
    children = plan.children()
    return own + sum(_exchanged(children.apply(i)) for i in range(children.size()))


def _lines(data: bytes, encoding: str) -> list[str]:
    """A plain model: units of the file, cut at line feeds."""
    unit, feed = len("a".encode(encoding)), "\n".encode(encoding)
    lines, line = [], b""
    for i in range(0, len(data), unit):
        if (piece := data[i : i + unit]) == feed:
            lines, line = [*lines, line], b""
        else:
            line += piece
    lines = [x.decode(encoding, "replace") for x in ([*lines, line] if line else lines)]
    lines = [x[:-1] if x.endswith("\r") else x for x in lines]
    return [lines[0].removeprefix("\ufeff"), *lines[1:]] if lines else lines


def test_only_border_pieces_move(spark, tmp_path, conf):
    """Every line has 40 cuts that are not aligned: neither they nor the lines are exchanged."""
    lines = [f"{i} " + PAIR * 40 for i in range(3000)]
    (tmp_path / "a.txt").write_bytes("".join(f"{x}\n" for x in lines).encode("UTF-16LE"))
    conf("spark.sql.files.maxPartitionBytes", str(1 << 17))
    df = read_sides(spark, {"left": str(tmp_path)}, "UTF-16LE")
    assert sorted((r.line_no, r.line) for r in df.collect()) == list(enumerate(lines, 1))
    assert _exchanged(df._jdf.queryExecution().executedPlan()) < 3000 / 4


@pytest.mark.parametrize("batch", ["1", "10000"])
@pytest.mark.parametrize("encoding", ["UTF-16LE", "UTF-32BE"])
def test_lines_over_blocks_and_batches(spark, tmp_path, conf, encoding, batch):
    """Lines longer than blocks and Arrow batches, blocks without an aligned cut, files of one task, an end that is no whole unit."""
    rng = random.Random(3)
    some = ["a", "\u010a", "\u0a00", PAIR, "\U00010a0a", "\u0a0a", "\U000a0000", "\r", " "]
    made = {}
    for name in "abcdef":
        lines = ["".join(rng.choice(some) for _ in range(rng.choice([0, 1, 5, 30, 900]))) for _ in range(20)]
        made[name] = "\n".join(lines).encode(encoding)
    made["b"] += "\n\n".encode(encoding)
    made["c"] = "\ufeff".encode(encoding) + made["c"]
    made["d"] += "a".encode(encoding)[:1]
    made["e"] = "".join(rng.choice(some) for _ in range(3000)).encode(encoding)
    for name, data in made.items():
        (tmp_path / f"{name}.txt").write_bytes(data)
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    for size in ("503", "100000"):  # many blocks, and files that share tasks
        conf("spark.sql.files.maxPartitionBytes", size)
        conf("spark.sql.files.openCostInBytes", "0")
        rows = read_sides(spark, {"left": str(tmp_path)}, encoding).collect()
        for name, data in made.items():
            got = sorted((r.line_no, r.line) for r in rows if r.file.endswith(f"/{name}.txt"))
            want = list(enumerate(_lines(data, encoding), 1))
            if name == "d":  # how the last unit's rest reads is the decoder's choice
                assert got[-1][0] == want[-1][0] and len(got) == len(want)
                got, want = got[:-1], want[:-1]
            assert got == want, (name, size)


def test_paths_named_twice(spark, tmp_path, conf):
    """A folder named twice is read twice, each file as one body."""
    for name in "ab":
        (tmp_path / f"{name}.txt").write_bytes("".join(f"{name}{i}{PAIR}\n" for i in range(50)).encode("UTF-16LE"))
    rows = read_sides(spark, {"left": [str(tmp_path), str(tmp_path)]}, "UTF-16LE").collect()
    for name in "ab":
        got = sorted((r.line_no, r.line) for r in rows if r.file.endswith(f"/{name}.txt"))
        assert got == list(enumerate([f"{name}{i}{PAIR}" for i in range(50)] * (len(rows) // 100), 1))
