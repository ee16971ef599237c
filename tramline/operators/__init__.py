from tramline.operators.extremes import busiest_with_ties, extreme_owners, extremes_with_owners
from tramline.operators.grouped import (
    bucket_histogram, distinct_count, distinct_members, distinct_pairs, running_total,
    share_by,
)
from tramline.operators.ordered import change_points, pair_distances, path_distance, with_previous

__all__ = [
    "busiest_with_ties", "extreme_owners", "extremes_with_owners",
    "bucket_histogram", "distinct_count", "distinct_members", "distinct_pairs",
    "running_total", "share_by",
    "change_points", "pair_distances", "path_distance", "with_previous",
]
