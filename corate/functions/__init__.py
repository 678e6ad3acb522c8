"""Column expressions shared by the operators."""

from corate.functions.scalars import (
    INT_MAX,
    INT_MIN,
    cosine,
    half_star_weight,
    java_int,
    pack_entries,
    similarity_scale,
    title_has_marker,
    title_year,
    unpack_entries,
)

__all__ = [
    "INT_MAX", "INT_MIN", "cosine", "half_star_weight", "java_int", "pack_entries",
    "similarity_scale", "title_has_marker", "title_year", "unpack_entries",
]
