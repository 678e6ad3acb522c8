"""Integer weights and sparse rows: scaling, packing into ``(col val)`` text and unpacking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.functions.scalars import half_star_weight, pack_entries, similarity_scale, unpack_entries

# A packed row holds the entries of one key whose column ids fall in one window of this width;
# a key with entries in several windows gets several segments, so no single group grows
# past this many entries however hot the key is.
SEGMENT_WIDTH = 1 << 20


def scaled_ratings(ratings: DataFrame) -> DataFrame:
    """``(user_id, item_id, w)`` with ``w = (int)(rating * 2)`` (half stars -> 1..10)."""
    return ratings.select("user_id", "item_id", half_star_weight("rating").alias("w"))


def scaled_similarity(sim: DataFrame) -> DataFrame:
    """``(item_1, item_2, val)`` with ``val = (int)(100 * similarity)``; NaN -> 0, +inf -> int max."""
    return sim.select("item_1", "item_2", similarity_scale("similarity").alias("val"))


def pack_rows(df: DataFrame, key: str, col: str, val: str, *,
              segment_width: int = SEGMENT_WIDTH) -> DataFrame:
    """Sparse rows ``(key, segment, packed)`` with ``packed = '\\t(col\\tval)...'`` in column order.

    ``segment = floor(col / segment_width)`` bounds every group at ``segment_width`` entries
    (columns are unique per key), so a hot key is spread over several groups. Concatenating a
    key's segments in segment order gives the whole row.
    """
    segment = F.floor(F.col(col) / F.lit(segment_width)).cast("bigint").alias("segment")
    entries = F.array_sort(F.collect_list(F.struct(F.col(col).alias("c"), F.col(val).alias("v"))))
    return (df.groupBy(key, segment).agg(entries.alias("_entries"))
            .select(key, "segment", pack_entries("_entries", "c", "v").alias("packed")))


def similarity_rows(sim_scaled: DataFrame, **kw) -> DataFrame:
    """Packed similarity matrix rows: ``(item_1, segment, packed)`` of ``(item_2, val)``."""
    return pack_rows(sim_scaled, "item_1", "item_2", "val", **kw)


def user_vectors(weights: DataFrame, **kw) -> DataFrame:
    """Packed user vectors: ``(user_id, segment, packed)`` of ``(item_id, w)``."""
    return pack_rows(weights, "user_id", "item_id", "w", **kw)


def unpack_rows(df: DataFrame, key: str, packed: str = "packed", *, col: str = "col",
                val: str = "val", last_wins: bool = False) -> DataFrame:
    """Packed rows back to long form ``(key, col, val)``; an absent/NULL row unpacks to nothing.

    Rows written by ``pack_rows`` never repeat a column. For foreign input that may,
    ``last_wins=True`` keeps the last entry of each ``(key, col)`` (text order), at the price of
    a shuffle on that pair.
    """
    exploded = df.select(F.col(key), F.posexplode(unpack_entries(packed)).alias("_pos", "_e"))
    out = exploded.select(key, "_pos", F.col("_e.key").alias(col), F.col("_e.value").alias(val))
    if last_wins:
        out = (out.groupBy(key, col).agg(F.max_by(val, "_pos").alias(val)))
    return out.select(key, col, val)


def unpack_arrays(df: DataFrame, key: str, packed: str = "packed") -> DataFrame:
    """Packed rows as ``(key, cols, vals)`` arrays, one row per packed row: the form that ``packed_scores`` joins,
    without a row per entry in between."""
    e = unpack_entries(packed)
    return df.select(key, e.alias("_e")).select(
        key, F.col("_e.key").alias("cols"), F.transform("_e", lambda x: x["value"].cast("int")).alias("vals"))
