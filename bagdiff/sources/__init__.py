"""Sources and sinks: text files, file listings, text columns of tables, bucket output."""

from bagdiff.sources.listing import files_from_paths, list_files
from bagdiff.sources.sinks import bucket_names, output_names, read_bucket, read_output, write_buckets
from bagdiff.sources.tables import bag_from_column, empty_occurrences, lines_from_column
from bagdiff.sources.text import decode_line, read_bag, read_lines, read_sides, scan_text

__all__ = [
    "bag_from_column",
    "bucket_names",
    "decode_line",
    "empty_occurrences",
    "files_from_paths",
    "lines_from_column",
    "list_files",
    "output_names",
    "read_bag",
    "read_bucket",
    "read_lines",
    "read_output",
    "read_sides",
    "scan_text",
    "write_buckets",
]
