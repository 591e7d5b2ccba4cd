"""DataFrame operators: counting, ranking, classification, pairing, bucket rows."""

from bagdiff.operators.classify import (
    bag_union,
    bucket_of,
    bucket_view,
    classify,
    except_all_keys,
    intersect_all_keys,
    key_counts,
    rank_occurrences,
    replicate,
)
from bagdiff.operators.groups import bucket_entries, slice_entries, unpack_entries, with_position
from bagdiff.operators.pairing import filter_names, group_files, grouped_paths, pair_files
from bagdiff.operators.partition import repartition_by_key

__all__ = [
    "bag_union",
    "bucket_entries",
    "bucket_of",
    "bucket_view",
    "classify",
    "except_all_keys",
    "filter_names",
    "group_files",
    "grouped_paths",
    "intersect_all_keys",
    "key_counts",
    "pair_files",
    "rank_occurrences",
    "repartition_by_key",
    "replicate",
    "slice_entries",
    "unpack_entries",
    "with_position",
]
