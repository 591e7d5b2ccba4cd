"""Command line: ``python -m bagdiff {files,dirs,pooled} LEFT RIGHT OUT [options]``.

Compares two files, two directories paired by file name, or two pooled
directories and writes the four sorted bucket outputs under ``OUT`` (one folder
per bucket, named after the sides, CRLF lines). Runs in whatever session ``spark-submit`` provides, or a
local one.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from bagdiff.plans.pipelines import DIRS, FILES, POOLED, diff_dirs, diff_files, diff_pooled_dirs, write_result
from bagdiff.session import enable_java_charsets, ensure_checkpoint_dir


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m bagdiff", description=__doc__.split("\n\n")[1])
    ap.add_argument("mode", choices=[FILES, DIRS, POOLED])
    ap.add_argument("left")
    ap.add_argument("right")
    ap.add_argument("out", help="output folder (must not exist)")
    ap.add_argument("--needle", default="", help="keep lines whose key contains this text")
    ap.add_argument("--name-needle", default="", help="dirs mode: keep files whose stem contains this text")
    ap.add_argument("--encoding", default="UTF-8")
    ap.add_argument("--space-sensitive", action="store_true", help="keep spaces in keys")
    ap.add_argument("--case-sensitive", action="store_true", help="keep letter case in keys")
    ap.add_argument("--normalize-needle", action="store_true", help="normalise the needle like the keys")
    ap.add_argument("--labels", nargs=2, metavar=("LEFT", "RIGHT"), help="names of the sides for the outputs (default: the paths)")
    ap.add_argument("--no-recursive", action="store_true", help="leave out folders below the given ones")
    ap.add_argument("--explain", action="store_true", help="print the physical plan of the comparison, write nothing")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("bagdiff").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.encoding.upper().replace("_", "-") not in ("UTF-8", "UTF8", "US-ASCII", "ISO-8859-1"):
        enable_java_charsets(spark)
    common = dict(
        needle=args.needle,
        encoding=args.encoding,
        space_sensitive=args.space_sensitive,
        case_sensitive=args.case_sensitive,
        normalize_needle=args.normalize_needle,
        recursive=not args.no_recursive,
    )
    if args.mode == FILES:
        res = diff_files(spark, args.left, args.right, **common)
    elif args.mode == DIRS:
        res = diff_dirs(spark, args.left, args.right, name_needle=args.name_needle, **common)
    else:
        res = diff_pooled_dirs(spark, args.left, args.right, **common)
    if args.explain:
        res.explain("formatted")
        return
    write_result(res, args.out, args.mode, labels=tuple(args.labels or (args.left, args.right)))


if __name__ == "__main__":
    main()
