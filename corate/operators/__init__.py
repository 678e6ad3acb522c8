"""Relational building blocks; every function takes and returns DataFrames."""

from corate.operators.catalog import filter_title, rating_lookup, ratings_in_catalog, ratings_of_item
from corate.operators.dedupe import latest_by_key, upsert, upsert_items, upsert_ratings
from corate.operators.incremental import add_stats, apply_changes, pair_stats_delta, rating_changes
from corate.operators.keyfilter import key_filter, semi_join
from corate.operators.matrix import blocked_scores, pack_matrix, packed_scores, plan_blocks
from corate.operators.recommend import format_recommendations, recommend, user_scores, user_scores_packed
from corate.operators.similarity import (
    candidate_pairs,
    co_ratings,
    frequent_pairs,
    item_similarity,
    pair_stats,
    pairs_by_item,
    rating_pair_stats,
    similarity_from_stats,
    unique_ratings,
)
from corate.operators.topk import top_k, top_k_per_user
from corate.operators.vectors import (
    pack_rows,
    scaled_ratings,
    scaled_similarity,
    similarity_rows,
    unpack_arrays,
    unpack_rows,
    user_vectors,
)

__all__ = [
    "add_stats", "apply_changes", "blocked_scores", "candidate_pairs", "co_ratings", "filter_title", "format_recommendations",
    "frequent_pairs", "item_similarity", "key_filter", "latest_by_key", "pack_matrix", "pack_rows", "packed_scores", "pair_stats",
    "pair_stats_delta", "pairs_by_item", "plan_blocks", "rating_pair_stats", "rating_changes", "rating_lookup", "ratings_in_catalog", "ratings_of_item", "recommend",
    "scaled_ratings", "scaled_similarity", "semi_join", "similarity_from_stats", "similarity_rows", "top_k", "top_k_per_user",
    "unique_ratings", "unpack_arrays", "unpack_rows", "upsert", "upsert_items", "upsert_ratings", "user_scores", "user_scores_packed", "user_vectors",
]
