from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from bagdiff.session import JAVA_CHARSET_CONF

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("bagdiff-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bagdiff-test-ckpt-"))
    )
    for k, v in JAVA_CHARSET_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    from bagdiff.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(session)
    yield session
    session.stop()


def occurrences(spark, lines, side, file=None):
    """Occurrence rows for a list of lines (1-based line numbers)."""
    file = file or f"{side}.txt"
    rows = [(side, file, i + 1, line) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "side string, file string, line_no long, line string")


def bucket_rows(entries):
    """{bucket: row texts in order} of rendered entries: a row's pieces joined by one space."""
    from collections import defaultdict

    from bagdiff.operators.groups import with_position

    rows = defaultdict(list)
    for r in sorted(with_position(entries).collect(), key=lambda r: (r.bucket, r.pos, r.position)):
        if r.position == 1:
            rows[r.bucket].append(r.piece)
        else:
            rows[r.bucket][-1] += " " + r.piece
    return dict(rows)


def emulate(left, right, space_sensitive=False, case_sensitive=False, needle=""):
    """Pure-Python model of the comparison: {(side, line_no): bucket}, plus groups."""
    from collections import defaultdict

    def key(line):
        k = line if space_sensitive else line.replace(" ", "")
        return k if case_sensitive else k.lower()

    occ = [(side, i + 1, line, key(line)) for side, lines in (("left", left), ("right", right)) for i, line in enumerate(lines)]
    occ = [o for o in occ if needle in o[3]]
    per = defaultdict(list)
    for o in occ:
        per[(o[3], o[0])].append(o)
    buckets, groups = {}, defaultdict(list)
    for (k, side), lst in per.items():
        lst.sort(key=lambda o: -o[1])
        m = min(len(per.get((k, "left"), [])), len(per.get((k, "right"), [])))
        for r, o in enumerate(lst, 1):
            b = ("comm_" if r <= m else "diff_") + side
            buckets[(side, o[1])] = b
            groups[(b, k)].append(o)
    rendered = defaultdict(list)
    for (b, k), lst in groups.items():
        text = "[" + ", ".join(f"{o[1]}:{o[2]}" for o in lst) + "]"
        rendered[b].append((lst[0][1], text))
    return buckets, {b: [t for _, t in sorted(v)] for b, v in rendered.items()}
