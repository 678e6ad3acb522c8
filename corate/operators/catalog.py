"""Catalog filters and key lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.functions.scalars import DEFAULT_TITLE_MARKER, title_has_marker
from corate.operators.keyfilter import key_filter
from corate.plans.skew import DEFAULT_BROADCAST_ROW_BYTES, DEFAULT_MAX_BROADCAST_BYTES

# Up to this many different keys are put into the scan's own condition.
PUSHED_KEYS = 128


def filter_title(items: DataFrame, marker: str = DEFAULT_TITLE_MARKER, title_col: str = "title") -> DataFrame:
    """Items whose title contains ``marker`` (substring test, first match, not a year parse)."""
    return items.filter(title_has_marker(title_col, marker))


def ratings_in_catalog(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Ratings whose item is in ``items`` (left semi join on ``item_id``).

    No broadcast hint: Spark broadcasts the catalog by its own size estimate and
    falls back to a sort-merge semi join when the catalog is large.
    """
    return ratings.join(items.select("item_id"), "item_id", "left_semi")


def ratings_of_item(ratings: DataFrame, item_id: int) -> DataFrame:
    """All ``(user_id, rating)`` of one item; the equality is pushed to the Parquet scan."""
    return ratings.filter(F.col("item_id") == F.lit(item_id)).select("user_id", "rating")


def _any(conditions: list[Column]) -> Column:
    """Their disjunction, as a balanced tree."""
    while len(conditions) > 1:
        conditions = [a | b for a, b in zip(conditions[::2], conditions[1::2])] + conditions[len(conditions) & ~1:]
    return conditions[0]


def rating_lookup(ratings: DataFrame, keys: DataFrame, *,
                  max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Bulk point lookup: each ``(user_id, item_id)`` of ``keys`` with its rating, NULL when absent.

    Up to ``PUSHED_KEYS`` different keys become conditions of the Parquet scan, which skips row groups by
    them (``write_clustered``). Key sets that fit a broadcast filter the ratings by a semi join where they are
    read, larger ones by a Bloom filter; in each case only hits (and the filter's few errors) are shuffled."""
    k = keys.select("user_id", "item_id")
    r = ratings.select("user_id", "item_id", "rating")
    wanted = k.distinct()
    n = wanted.count()
    if n <= PUSHED_KEYS:
        known = wanted.dropna().take(PUSHED_KEYS)
        r = r.filter(_any([(F.col("item_id") == x["item_id"]) & (F.col("user_id") == x["user_id"]) for x in known]) if known else F.lit(False))
    elif n * DEFAULT_BROADCAST_ROW_BYTES <= max_broadcast_bytes:
        r = r.join(F.broadcast(wanted), ["user_id", "item_id"], "left_semi")
    else:
        r = r.filter(key_filter(wanted, ["user_id", "item_id"], n))
    return k.join(r, ["user_id", "item_id"], "left")
