"""Column expressions: keys, needles, paths, labels, entry rendering."""

from bagdiff.functions.keys import contains_needle, normalize_needle, normalize_text
from bagdiff.functions.paths import (
    base_name,
    clean_path,
    default_label,
    dir_label,
    output_base,
    output_name,
    stem,
)
from bagdiff.functions.text import BARE, LABELED, NUMBERED, entry_text, piece_text

__all__ = [
    "BARE",
    "LABELED",
    "NUMBERED",
    "base_name",
    "clean_path",
    "contains_needle",
    "default_label",
    "dir_label",
    "entry_text",
    "normalize_needle",
    "normalize_text",
    "output_base",
    "output_name",
    "piece_text",
    "stem",
]
