"""Entry and list rendering (P5, P12) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bagdiff import schema as S

NUMBERED = "numbered"  # "<n>:<line>"          (two files)
LABELED = "labeled"  # "文件<file><n>:<line>"  (directory pairs)
BARE = "bare"  # "<line>"                (pooled directories)
ENTRY_FORMATS = (NUMBERED, LABELED, BARE)


def entry_text(line_no: Column, line: Column, file: Column | None = None, fmt: str = NUMBERED) -> Column:
    """Text of one entry in a rendered bucket row."""
    if fmt == NUMBERED:
        return F.concat(line_no.cast("string"), F.lit(":"), line)
    if fmt == LABELED:
        return F.concat(F.lit(S.FILE_LABEL_PREFIX), F.coalesce(file, F.lit("")), line_no.cast("string"), F.lit(":"), line)
    if fmt == BARE:
        return line
    raise ValueError(f"entry format must be one of {ENTRY_FORMATS}")


def piece_text(entry: Column, first: Column, last: Column) -> Column:
    """An entry as it stands in its row: ``[`` before the first, ``]`` after the last, ``,`` after any other."""
    return F.concat(
        F.when(first, F.lit(S.LIST_OPEN)).otherwise(F.lit("")),
        entry,
        F.when(last, F.lit(S.LIST_CLOSE)).otherwise(F.lit(S.LIST_COMMA)),
    )
