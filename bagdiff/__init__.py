"""bagdiff: compare two bodies of text as multisets of lines, on Spark.

Every line gets a comparison key (optionally ignoring spaces and letter case),
optionally filtered by a needle; per key the latest ``least(n_left, n_right)``
occurrences of each side are common, the rest differ. Results are DataFrames.
"""

from bagdiff.plans.pipelines import (
    DIRS,
    compare,
    FILES,
    POOLED,
    diff_dirs,
    diff_file_pairs,
    diff_files,
    diff_lines,
    diff_pooled,
    diff_pooled_dirs,
    keep_needle,
    render,
    side_label,
    with_key,
    write_result,
)

__all__ = [
    "DIRS",
    "compare",
    "FILES",
    "POOLED",
    "diff_dirs",
    "diff_file_pairs",
    "diff_files",
    "diff_lines",
    "diff_pooled",
    "diff_pooled_dirs",
    "keep_needle",
    "render",
    "side_label",
    "with_key",
    "write_result",
]
