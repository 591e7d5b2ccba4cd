"""Schemas, side and bucket names, and tuning constants shared by the package."""

from __future__ import annotations

from pyspark.sql import types as T

LEFT = "left"
RIGHT = "right"

COMM_LEFT = "comm_left"
COMM_RIGHT = "comm_right"
DIFF_LEFT = "diff_left"
DIFF_RIGHT = "diff_right"
BUCKETS = (COMM_LEFT, COMM_RIGHT, DIFF_LEFT, DIFF_RIGHT)

# Fixed values that must equal the reference's output format:
#   entry label prefix for files "文件", directory label prefix "目录",
#   output file name prefixes "Comm " and "Diff ", output suffix ".txt",
#   list rendering "[" + entries joined by "," and a space + "]".
FILE_LABEL_PREFIX = "文件"
DIR_LABEL_PREFIX = "目录"
COMM_NAME_PREFIX = "Comm "
DIFF_NAME_PREFIX = "Diff "
OUTPUT_SUFFIX = ".txt"
LIST_OPEN = "["
LIST_COMMA = ","
LIST_CLOSE = "]"

# A key with over HEAVY_ROWS lines is ranked in chunks of 2**CHUNK_BITS consecutive
# line numbers, so no task holds more than that of it. HEAVY_DRAWS lines of such a key are
# drawn to find it.
HEAVY_ROWS = 1 << 20
CHUNK_BITS = 20
HEAVY_DRAWS = 128
HEAVY_SEED = 20
# Documents are numbered in blocks of 2**DOC_BLOCK_BITS consecutive ids; blocks form
# groups of 2**DOC_LEVEL_BITS, and these again, so that no window holds more whatever
# the ids (64 = 10 + 2 * 27); these rows are narrow, and dense ids fill a group with 2**37 documents only.
DOC_BLOCK_BITS = 10
DOC_LEVEL_BITS = 27
# Lines of a text block are exchanged in sub-blocks of at most 2**LINE_BLOCK_BITS lines.
LINE_BLOCK_BITS = 18

OCCURRENCE = T.StructType(
    [
        T.StructField("side", T.StringType(), False),
        T.StructField("file", T.StringType(), True),
        T.StructField("line_no", T.LongType(), False),
        T.StructField("line", T.StringType(), False),
        T.StructField("key", T.StringType(), False),
    ]
)
