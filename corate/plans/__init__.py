"""Physical-plan choices (skew splitting, bounded broadcasts) and the composed jobs."""

from corate.plans.skew import (
    HotSplit,
    broadcast_if_bounded,
    chunk_of,
    default_partitions,
    equi_join_rows,
    partitions_for,
    split_hot_keys,
)

__all__ = ["HotSplit", "broadcast_if_bounded", "chunk_of", "default_partitions", "equi_join_rows",
           "partitions_for", "split_hot_keys"]
