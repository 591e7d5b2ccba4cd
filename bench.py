"""Benchmark: the three comparisons on the supplied tables.

Runs ``diff_files`` (X), ``diff_dirs`` (Y) and ``diff_pooled_dirs`` (Z) from the
contract on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``; all queries run once to warm up, then each is timed
``$BENCH_RUNS`` times (default 5) with a no-op sink that computes every column.
Prints one JSON line with the median seconds per query and their sum.
``extra_queries`` (not in the sum) times the text-file reader: the lines of X
written once as two CRLF text files and compared with ``diff_files``
(``BENCH_TEXT=0`` skips it).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from bagdiff import diff_files  # noqa: E402
from bagdiff.plans import contract  # noqa: E402
from bagdiff.session import local_session, scratch_path  # noqa: E402

HEADLINE = ("diff_files", "diff_dirs", "diff_pooled_dirs")


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bagdiff-bench")
    qs = contract.queries()
    medians: dict[str, float] = {}
    for name in HEADLINE:  # warm the JVM on every query before timing any
        run_once(spark, qs[name], sf_dir)
    for name in HEADLINE:
        times = [run_once(spark, qs[name], sf_dir) for _ in range(runs)]
        medians[name] = round(statistics.median(times), 3)
    extra = {}
    if os.environ.get("BENCH_TEXT", "1") == "1":
        # the text-file reader: X written once as two CRLF text files, then compared
        root = scratch_path(spark, "bench-text")
        lines = contract.x_lines(spark, sf_dir)
        lines.repartitionByRange("side", "line_no").sortWithinPartitions("side", "line_no").select(
            "side", "line"
        ).write.partitionBy("side").option("lineSep", "\r\n").text(root)

        def text_files(spark, _sf):
            return diff_files(spark, f"{root}/side=left", f"{root}/side=right")

        run_once(spark, text_files, sf_dir)
        extra["diff_text_files"] = round(statistics.median(run_once(spark, text_files, sf_dir) for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "extra_queries": extra,
                "sf": sf,
                "runs": runs,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
