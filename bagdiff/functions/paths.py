"""Path and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bagdiff import schema as S


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_path(uri: str | Column) -> Column:
    """A readable path from a Spark file URI.

    ``inputFiles()`` spells local files ``file:///x`` and ``_metadata.file_path``
    spells them ``file:/x``; both percent-encode. Local paths lose the scheme;
    ``+`` is protected before URL decoding, which would turn it into a space.
    """
    u = F.regexp_replace(_col(uri), r"^file:(//)?(?=/)", "")
    # a malformed escape keeps the path as given instead of failing the job
    return F.coalesce(F.try_url_decode(F.replace(u, F.lit("+"), F.lit("%2B"))), u)


def base_name(path: str | Column) -> Column:
    """Last ``/`` segment of a path."""
    return F.regexp_extract(_col(path), r"([^/]*)$", 1)


def stem(path: str | Column) -> Column:
    """Base name up to its first ``.`` (the reference cut the whole path, so a dotted
    directory changed the stem; here only the base name counts)."""
    return F.substring_index(base_name(path), ".", 1)


def dir_label(glob_path: str | Column) -> Column:
    """Directory label: second-last segment of a path or glob (either slash), with
    the directory prefix; a path without a slash is the directory itself."""
    path = _col(glob_path)
    parts = F.split(F.when(path.rlike(r"[/\\]"), path).otherwise(F.concat(path, F.lit("/"))), r"[/\\]")
    return F.concat(F.lit(S.DIR_LABEL_PREFIX), F.element_at(parts, -2))


def default_label(name: str | Column, directory: bool = False) -> Column:
    """Default side label: the file or directory prefix followed by the caller's name."""
    prefix = S.DIR_LABEL_PREFIX if directory else S.FILE_LABEL_PREFIX
    return F.concat(F.lit(prefix), _col(name))


def output_base(label: str | Column) -> Column:
    """Name part of an output file: the label cut at its first ``.``, then its last
    ``/`` segment (slashes at its end do not count)."""
    cut = F.regexp_replace(F.substring_index(_col(label), ".", 1), "/+$", "")
    return F.element_at(F.split(cut, "/"), -1)


def output_name(label: str | Column, common: bool) -> Column:
    """``Comm <name>.txt`` or ``Diff <name>.txt`` for a side label."""
    prefix = S.COMM_NAME_PREFIX if common else S.DIFF_NAME_PREFIX
    return F.concat(F.lit(prefix), output_base(label), F.lit(S.OUTPUT_SUFFIX))
