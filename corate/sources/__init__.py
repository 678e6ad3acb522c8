"""Readers for catalogs, rating logs, similarity text, packed rows and written tables."""

from corate.sources.readers import (
    dump_table,
    item_rejects,
    read_items,
    read_packed,
    read_packed_entries,
    read_ratings,
    read_similarity,
    read_split,
    similarity_rejects,
    split_log,
)

__all__ = ["dump_table", "item_rejects", "read_items", "read_packed", "read_packed_entries", "read_ratings",
           "read_similarity", "read_split", "similarity_rejects", "split_log"]
