"""Skew handling and size-checked broadcasts.

A single user or item may own a large share of all rows. Keys with more rows than a fixed degree
threshold are *hot*: their groups are cut into chunks of about ``threshold`` rows, so no task
receives a whole hot group. One partially aggregated degree count finds them and also counts them;
the hot-key table is broadcast only when that count is within ``max_hot_keys`` (a proven size), and
is otherwise joined by a shuffle, where AQE's skew-join split keeps the hot rows apart.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default ceilings. A broadcast hash table row of (bigint, bigint, int) costs ~48 bytes.
DEFAULT_MAX_HOT_KEYS = 100_000
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024
DEFAULT_BROADCAST_ROW_BYTES = 48


# Rows produced per task after a multiplying join (self join, row expansion): keeps the hash
# aggregate behind the join small enough to stay cache-resident.
DEFAULT_ROWS_PER_TASK = 1_000_000
# Partial products per scoring task: their distinct (user, item) keys (at most this many) then
# mostly fit Spark's first-level aggregate hash map.
SCORING_ROWS_PER_TASK = 512 * 1024
# Scores per cell where both sides are sent by shuffle: they are copied with the square root of the number of cells,
# so cells are as large as an aggregate of that many keys allows.
BLOCK_ROWS_PER_TASK = 16 * 1024 * 1024
MAX_PARTITIONS = 100_000


@dataclass
class HotSplit:
    """Rows of ordinary keys, rows of hot keys (with ``n_chunks``), the degree threshold,
    ``sum(degree^2)`` over all keys (the row count of a self join on the key), and the hot-key
    table ``(key, n_chunks)`` itself (broadcast-hinted when small)."""

    normal: DataFrame
    hot: DataFrame | None
    threshold: int
    square_sum: int = 0
    keys: DataFrame | None = None


def split_hot_keys(df: DataFrame, key: str, *, min_degree: int,
                   max_hot_keys: int = DEFAULT_MAX_HOT_KEYS,
                   chunk_col: str = "n_chunks", known: tuple[int, int] | None = None) -> HotSplit:
    """Split ``df`` into rows of ordinary keys and rows of keys with more than ``min_degree`` rows.

    Hot rows carry ``chunk_col = ceil(degree / min_degree)``: the number of pieces the group is
    cut into, each about ``min_degree`` rows. One aggregation job (degrees, combined map-side)
    returns the row count, the largest degree, ``sum(degree^2)`` and the number of hot keys; when
    nothing is hot the input is returned unchanged and no join is added. ``known`` gives
    ``(sum(degree^2), number of hot keys)`` where the caller has them, and saves the job.
    """
    threshold = int(min_degree)
    deg = df.groupBy(key).agg(F.count(F.lit(1)).alias("_deg"))
    if known is None:
        stats = deg.agg(F.sum(F.col("_deg") * F.col("_deg")).alias("sq"),
                        F.count(F.when(F.col("_deg") > threshold, True)).alias("n_hot")).first()
        known = (stats["sq"] or 0), (stats["n_hot"] or 0)
    sq, n_hot = known
    if n_hot == 0:
        return HotSplit(df, None, threshold, sq)
    hot = deg.filter(F.col("_deg") > threshold).select(
        key, F.ceil(F.col("_deg") / F.lit(threshold)).cast("int").alias(chunk_col))
    if n_hot <= max_hot_keys:
        hot = F.broadcast(hot)  # n_hot rows of (key, int), counted above
    normal = df.join(hot, key, "left_anti")
    heavy = df.join(hot, key, "inner")
    return HotSplit(normal, heavy, threshold, sq, hot)


def chunk_of(col: str, n_chunks: str = "n_chunks") -> "F.Column":
    """Deterministic chunk number in ``[0, n_chunks)`` from a hash of ``col``."""
    return F.pmod(F.xxhash64(F.col(col)), F.col(n_chunks).cast("long")).cast("int")


def broadcast_if_bounded(df: DataFrame, *, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                         row_bytes: int = DEFAULT_BROADCAST_ROW_BYTES) -> tuple[DataFrame, bool]:
    """Hint ``df`` for broadcast only when ``rows * row_bytes <= max_bytes``.

    Counts the rows (cheap on a written table: Parquet footers). Returns the possibly
    hinted frame and whether the hint was applied; callers keep a shuffle plan for the
    other case.
    """
    rows = df.count()
    if rows * row_bytes <= max_bytes:
        return F.broadcast(df), True
    return df, False


def default_partitions(spark) -> int:
    """The session's shuffle partition count (at least the default parallelism)."""
    conf = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(conf, spark.sparkContext.defaultParallelism)


def partitions_for(spark, rows: int, rows_per_task: int = DEFAULT_ROWS_PER_TASK) -> int:
    """Partitions for a stage that produces ``rows`` rows: ``rows / rows_per_task``, at least the
    session default, at most ``MAX_PARTITIONS``."""
    want = math.ceil(max(rows, 0) / rows_per_task)
    return int(min(MAX_PARTITIONS, max(default_partitions(spark), want)))


def equi_join_rows(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> int:
    """Exact output row count of ``left JOIN right ON left_key = right_key``: the sum over keys of
    the product of per-key counts. Two partially aggregated counts and a join of one row per key;
    a hot key costs nothing extra."""
    lc = left.groupBy(F.col(left_key).alias("_k")).agg(F.count(F.lit(1)).alias("_l"))
    rc = right.groupBy(F.col(right_key).alias("_k")).agg(F.count(F.lit(1)).alias("_r"))
    total = lc.join(rc, "_k").agg(F.sum(F.col("_l") * F.col("_r")).alias("rows")).first()["rows"]
    return int(total or 0)
