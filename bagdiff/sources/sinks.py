"""Text output of the four buckets (K1, K2, K3).

One job writes all buckets: entries are range-partitioned and sorted by (output,
first entry, position), then written as text partitioned by output, so the part
files of one output folder read in name order give the bucket in order. Each line is
one entry, ended by CRLF as the reference's rows are; the lines from one that begins
with ``[`` to one that ends with ``]`` are a bucket row. All four outputs exist, also
those without rows, and only when all four do is ``path/_COMPLETE`` written, so a set that a
crash left half-made can be told (:func:`is_complete`). Names in the reference's style (``Comm <name>.txt``) come from
:func:`bucket_names`; without them, or where two would be the same, the folders are
``bucket=<bucket>``, so two sides never overwrite each other.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bagdiff import schema as S
from bagdiff.functions.paths import output_name
from bagdiff.operators.groups import SORT_KEYS


#: Hidden folder that is written after all outputs.
COMPLETE = "_COMPLETE"


def bucket_names(left_label: str, right_label: str) -> dict[str, str] | None:
    """Reference-style output names per bucket (``Comm a.txt``, ...), or None when
    two buckets would get the same name (the reference then overwrote one)."""

    def base(label: str) -> str:
        return label.split(".", 1)[0].rstrip("/").split("/")[-1]

    names = {
        S.COMM_LEFT: f"{S.COMM_NAME_PREFIX}{base(left_label)}{S.OUTPUT_SUFFIX}",
        S.DIFF_LEFT: f"{S.DIFF_NAME_PREFIX}{base(left_label)}{S.OUTPUT_SUFFIX}",
        S.COMM_RIGHT: f"{S.COMM_NAME_PREFIX}{base(right_label)}{S.OUTPUT_SUFFIX}",
        S.DIFF_RIGHT: f"{S.DIFF_NAME_PREFIX}{base(right_label)}{S.OUTPUT_SUFFIX}",
    }
    return names if len(set(names.values())) == len(names) else None


def _folder(column: str, value: str) -> str:
    """``column=value`` as Spark names a partition folder: characters with a meaning in paths are escaped."""
    return f"{column}=" + re.sub(r"""[\x00-\x1f\x7f"#%'*/:=?\\{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", value)


def write_buckets(
    entries: DataFrame,
    path: str,
    line_sep: str = "\r\n",
    mode: str = "errorifexists",
    names: dict[str, str] | None = None,
) -> None:
    """Write the entries of bucket rows to ``path/bucket=<bucket>/part-*.txt`` in order.

    With ``names`` (see :func:`bucket_names`) the folders are
    ``path/output=<name>/`` instead, e.g. ``output=Comm a.txt``.
    """
    part, outputs = ("output", names) if names else ("bucket", {b: b for b in S.BUCKETS})
    mapping = F.create_map(*[F.lit(x) for kv in outputs.items() for x in kv])
    keys = [part, *SORT_KEYS[1:]]
    rows = entries.withColumn(part, mapping[F.col("bucket")]).select(*keys, "piece")
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.select(part, "piece").write.mode(mode).partitionBy(part).option("lineSep", line_sep).text(path)
    empty = entries.sparkSession.range(0).select(F.lit("").alias("piece"))
    for name in outputs.values():  # a bucket without rows still has its output
        empty.write.mode("ignore").text(f"{path.rstrip('/')}/{_folder(part, name)}")
    empty.write.mode("overwrite").text(f"{path.rstrip('/')}/{COMPLETE}")


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether all four outputs under ``path`` were written to the end."""
    try:
        # an underscore hides a folder from scans of its parent, not from a scan of itself
        spark.read.text(f"{path.rstrip('/')}/{COMPLETE}").isEmpty()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_bucket(spark: SparkSession, path: str, bucket: str, line_sep: str = "\r\n") -> DataFrame:
    """Lines of one written bucket (for checks); ``_m`` keeps file order."""
    return read_output(spark, f"{path}/{_folder('bucket', bucket)}", line_sep)


def read_output(spark: SparkSession, folder: str, line_sep: str = "\r\n") -> DataFrame:
    """Lines of one output folder: ``part_file, _m, value``."""
    return (
        spark.read.option("lineSep", line_sep)
        .text(folder)
        .select(F.col("_metadata.file_name").alias("part_file"), F.monotonically_increasing_id().alias("_m"), "value")
    )


def output_names(labels: DataFrame) -> DataFrame:
    """``side, bucket, label, name`` for ``side, label`` rows: the reference's output file name per bucket."""
    both = labels.select("side", "label", F.explode(F.array(F.lit(True), F.lit(False))).alias("common"))
    return both.select(
        "side",
        F.concat(F.when(F.col("common"), F.lit("comm_")).otherwise(F.lit("diff_")), F.col("side")).alias("bucket"),
        "label",
        F.when(F.col("common"), output_name("label", True)).otherwise(output_name("label", False)).alias("name"),
    )
