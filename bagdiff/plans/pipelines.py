"""User-facing comparisons.

Each returns the occurrence-level result ``classified`` (one row per compared
line with ``n_left, n_right, occ_rank, bucket``); :func:`render` and
:func:`write_result` turn it into the reference's four sorted text outputs.

* E1 :func:`diff_lines` / :func:`diff_files`: two bodies of lines.
* E2 :func:`diff_file_pairs` / :func:`diff_dirs`: files of two directories paired
  by base name, all pairs compared in one job (``file`` is a grouping column;
  no loop over pairs).
* E3 :func:`diff_pooled` / :func:`diff_pooled_dirs`: every line of each directory
  pooled into one bag per side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bagdiff import schema as S
from bagdiff.functions.keys import contains_needle, normalize_needle, normalize_text
from bagdiff.functions.paths import base_name
from bagdiff.functions.text import BARE, LABELED, NUMBERED
from bagdiff.operators.classify import bag_union, classify
from bagdiff.operators.groups import bucket_entries
from bagdiff.operators.pairing import filter_names, pair_files
from bagdiff.sources.listing import list_files
from bagdiff.sources.sinks import bucket_names, write_buckets
from bagdiff.sources.text import read_bag, read_sides

FILES = "files"
DIRS = "dirs"
POOLED = "pooled"
_MODES = {
    # one file per side in the reference; with several, lines rank by (file, line)
    FILES: dict(by=(), order=("file", "line_no"), fmt=NUMBERED),
    DIRS: dict(by=("file",), order=("line_no",), fmt=LABELED),
    POOLED: dict(by=(), order=("file", "line_no"), fmt=BARE),
}


def named(occ: DataFrame) -> DataFrame:
    """``file`` is a join key inside the comparison: a missing or NULL file name is
    the empty name, so no line is lost to NULL-never-equal joins."""
    if "file" not in occ.columns:
        return occ.withColumn("file", F.lit(""))
    return occ.withColumn("file", F.coalesce(F.col("file"), F.lit("")))


def _key_of(space_sensitive: bool, case_sensitive: bool):
    return lambda line: normalize_text(line, space_sensitive, case_sensitive)


def with_key(occ: DataFrame, space_sensitive: bool = False, case_sensitive: bool = False) -> DataFrame:
    """Add the comparison ``key`` to ``side, file, line_no, line`` rows."""
    return occ.withColumn("key", normalize_text("line", space_sensitive, case_sensitive))


def keep_needle(
    occ: DataFrame,
    needle: str | None,
    space_sensitive: bool = False,
    case_sensitive: bool = False,
    normalize: bool = False,
) -> DataFrame:
    """Keep occurrences whose key contains ``needle``.

    As in the reference the raw needle is matched against the normalised key, so
    with default flags a needle with capitals or spaces matches nothing;
    ``normalize=True`` normalises the needle first. The filter sits above line
    numbering, so numbers count every line of the input.
    """
    if needle and normalize:
        needle = normalize_needle(needle, space_sensitive, case_sensitive)
    return occ if not needle else occ.where(contains_needle("key", needle))


def _prepare(occ, needle, space_sensitive, case_sensitive, normalize):
    # a text line is never NULL; NULL rows of a user table are skipped explicitly
    occ = occ.where(F.col("line").isNotNull())
    return keep_needle(with_key(occ, space_sensitive, case_sensitive), needle, space_sensitive, case_sensitive, normalize)


def compare(
    occ: DataFrame,
    mode: str = FILES,
    needle: str | None = "",
    space_sensitive: bool = False,
    case_sensitive: bool = False,
    normalize_needle: bool = False,
    heavy_rows: int | None = S.HEAVY_ROWS,
    chunk_bits: int = S.CHUNK_BITS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """E1 (``FILES``) or E3 (``POOLED``) on one occurrence DataFrame holding both
    sides (``side, file, line_no, line``). For ``DIRS`` use :func:`diff_file_pairs`,
    which also needs the file listing.

    A job looks for heavy keys when this is called: in ``probe``, the same lines without
    numbers (``side, file, line``), which need no exchange, else in ``occ``; with
    ``heavy_rows=None`` nothing runs."""
    if mode not in (FILES, POOLED):
        raise ValueError("compare() takes FILES or POOLED; use diff_file_pairs for DIRS")
    flags = (needle, space_sensitive, case_sensitive, normalize_needle)
    occ, probe = _prepare(named(occ), *flags), None if probe is None else _prepare(named(probe), *flags)
    key_of = _key_of(space_sensitive, case_sensitive)
    return classify(occ, **rank_args(mode), heavy_rows=heavy_rows, chunk_bits=chunk_bits, key_of=key_of, probe=probe)


def diff_lines(
    left: DataFrame,
    right: DataFrame,
    needle: str | None = "",
    space_sensitive: bool = False,
    case_sensitive: bool = False,
    normalize_needle: bool = False,
    heavy_rows: int | None = S.HEAVY_ROWS,
    chunk_bits: int = S.CHUNK_BITS,
) -> DataFrame:
    """E1 on two occurrence DataFrames (``side, file, line_no, line``)."""
    return compare(bag_union(left, right), FILES, needle, space_sensitive, case_sensitive, normalize_needle, heavy_rows, chunk_bits)


def diff_files(
    spark: SparkSession,
    path_left: str,
    path_right: str,
    needle: str | None = "",
    encoding: str = "UTF-8",
    space_sensitive: bool = False,
    case_sensitive: bool = False,
    normalize_needle: bool = False,
    heavy_rows: int | None = S.HEAVY_ROWS,
    chunk_bits: int = S.CHUNK_BITS,
    recursive: bool = True,
) -> DataFrame:
    """Compare two text files (or any two path sets, each read as one body)."""
    sides = {S.LEFT: path_left, S.RIGHT: path_right}
    occ, probe = read_sides(spark, sides, encoding, recursive), read_bag(spark, sides, encoding, recursive)
    return compare(occ, FILES, needle, space_sensitive, case_sensitive, normalize_needle, heavy_rows, chunk_bits, probe)


def rank_args(mode: str) -> dict:
    m = _MODES[mode]
    return dict(by=m["by"], order=m["order"])


def diff_file_pairs(
    occ: DataFrame,
    files: DataFrame,
    name_needle: str | None = "",
    needle: str | None = "",
    space_sensitive: bool = False,
    case_sensitive: bool = False,
    normalize_needle: bool = False,
    heavy_rows: int | None = S.HEAVY_ROWS,
    chunk_bits: int = S.CHUNK_BITS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """E2 on occurrences whose ``file`` is a base name, given the file listing
    ``side, path, file_name, stem`` (which also holds empty files). ``probe`` as in :func:`compare`.

    Lines of unpaired files are dropped by a semi-join before they move to their keys;
    Spark broadcasts the pairs when their measured size allows it, and joins by
    shuffle (splitting a file that holds very many lines) when not.
    """
    pairs = pair_files(filter_names(files, name_needle)).select(F.col("file_name").alias("file"))
    flags = (needle, space_sensitive, case_sensitive, normalize_needle)
    occ = _prepare(named(occ), *flags).join(pairs, "file", "left_semi")
    # lines of unpaired files may stay in the probe: a key that is heavy only with them is dealt to parts too
    probe = None if probe is None else _prepare(named(probe), *flags)
    by, order = _MODES[DIRS]["by"], _MODES[DIRS]["order"]
    return classify(occ, by, order, heavy_rows, chunk_bits, key_of=_key_of(space_sensitive, case_sensitive), probe=probe)


def diff_dirs(
    spark: SparkSession,
    dir_left: str,
    dir_right: str,
    name_needle: str | None = "",
    needle: str | None = "",
    encoding: str = "UTF-8",
    space_sensitive: bool = False,
    case_sensitive: bool = False,
    normalize_needle: bool = False,
    heavy_rows: int | None = S.HEAVY_ROWS,
    chunk_bits: int = S.CHUNK_BITS,
    recursive: bool = True,
) -> DataFrame:
    """Compare the files of two directories paired by base name.

    ``recursive`` also reads folders below; a name found there too is then on its side
    twice and not paired.
    """
    files = list_files(spark, dir_left, S.LEFT, recursive).unionByName(list_files(spark, dir_right, S.RIGHT, recursive))
    sides = {S.LEFT: dir_left, S.RIGHT: dir_right}
    occ, probe = (
        read(spark, sides, encoding, recursive).withColumn("file", base_name("file")) for read in (read_sides, read_bag)
    )
    return diff_file_pairs(
        occ, files, name_needle, needle, space_sensitive, case_sensitive, normalize_needle, heavy_rows, chunk_bits, probe
    )


def diff_pooled(
    left: DataFrame,
    right: DataFrame,
    needle: str | None = "",
    space_sensitive: bool = False,
    case_sensitive: bool = False,
    normalize_needle: bool = False,
    heavy_rows: int | None = S.HEAVY_ROWS,
    chunk_bits: int = S.CHUNK_BITS,
) -> DataFrame:
    """E3 on two occurrence DataFrames: one bag per side, file ignored for keys.

    The reference gives pooled entries no order; here the latest (file, line_no)
    occurrences are the common ones, which makes the result deterministic.
    """
    return compare(bag_union(left, right), POOLED, needle, space_sensitive, case_sensitive, normalize_needle, heavy_rows, chunk_bits)


def diff_pooled_dirs(
    spark: SparkSession,
    dir_left: str,
    dir_right: str,
    needle: str | None = "",
    encoding: str = "UTF-8",
    space_sensitive: bool = False,
    case_sensitive: bool = False,
    normalize_needle: bool = False,
    heavy_rows: int | None = S.HEAVY_ROWS,
    chunk_bits: int = S.CHUNK_BITS,
    recursive: bool = True,
) -> DataFrame:
    """Compare every line of two directories, each pooled into one bag."""
    sides = {S.LEFT: dir_left, S.RIGHT: dir_right}
    occ, probe = read_sides(spark, sides, encoding, recursive), read_bag(spark, sides, encoding, recursive)
    return compare(occ, POOLED, needle, space_sensitive, case_sensitive, normalize_needle, heavy_rows, chunk_bits, probe)


def render(classified: DataFrame, mode: str = FILES) -> DataFrame:
    """Bucket rows of a result, one record per entry, in the reference's text form for ``mode``."""
    m = _MODES[mode]
    return bucket_entries(classified, by=m["by"], fmt=m["fmt"])


def side_label(name: str, mode: str = FILES) -> str:
    """The reference's label of a side: the file prefix and the caller's name for two
    files, the directory prefix and the folder for directory pairs (the second-last
    segment of a path or glob), the directory prefix and the caller's name for pooled
    directories."""
    if mode == FILES:
        return S.FILE_LABEL_PREFIX + name
    if mode == POOLED:
        return S.DIR_LABEL_PREFIX + name
    parts = name.replace("\\", "/").split("/")
    return S.DIR_LABEL_PREFIX + (parts[-2] if len(parts) > 1 else parts[0])


def write_result(
    classified: DataFrame,
    path: str,
    mode: str = FILES,
    line_sep: str = "\r\n",
    labels: tuple[str, str] | None = None,
) -> None:
    """Render and write the four buckets under ``path``. With ``labels`` (the names or
    paths of left and right) the folders carry the reference's names for the mode
    (``Comm <name>.txt``, see :func:`side_label`) unless two would collide."""
    names = bucket_names(*[side_label(x, mode) for x in labels]) if labels else None
    write_buckets(render(classified, mode), path, line_sep, names=names)


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


