"""Scoring users against the item similarity matrix and picking their top items.

``score(u, j) = sum_i w(u, i) * val(i, j)`` over the items ``i`` the user rated, where ``w`` is
the integer half-star weight and ``val`` the integer similarity. Scores are bigint.

Plan when the packed similarity rows pass the broadcast size check (the usual case: two arrays per
item, 5 bytes per frequent item pair where ids and values allow it, else up to 12):

    weights --repartition(user)--> broadcast join packed rows --> expand --> aggregate (user, item)
            --> top-k window per user [--> pad]

Everything after the one exchange of the small weight rows stays in the same partitions: the
per-user partial products, which outnumber the ratings by the similarity row length, are never
shuffled. The options keep that shape: excluding seen items joins diagonal marker rows along
with the matrix (no anti join, which would re-shuffle the scores on (user, item)), and padding
uses a left outer join so users without any score still reach the per-user window. Hot users are cut
into item chunks and scored in a second branch with its own exchanges, so no task receives a whole hot
user. When the packed rows are too large to broadcast, users and columns are dealt into blocks and
each cell computes its scores complete (``corate.operators.matrix``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.functions.scalars import pack_entries
from corate.operators.matrix import INTEGRAL, Narrow, blocked_scores, narrow, pack_matrix, packed_bytes, packed_scores, plan_blocks
from corate.operators.topk import top_k_per_user
from corate.operators.vectors import scaled_ratings, scaled_similarity, unpack_arrays
from corate.plans.skew import (
    BLOCK_ROWS_PER_TASK,
    DEFAULT_MAX_BROADCAST_BYTES,
    DEFAULT_MAX_HOT_KEYS,
    SCORING_ROWS_PER_TASK,
    HotSplit,
    chunk_of,
    partitions_for,
    split_hot_keys,
)
from corate.session import materialize

# Users with more rated items than this are scored in item chunks of about this size.
DEFAULT_HOT_USER_DEGREE = 2000


def _matrix(sim_scaled: DataFrame, symmetric: bool, markers: bool = False) -> DataFrame:
    """``(item_1, item_2, val)``, mirrored when ``symmetric``.

    ``markers`` adds a diagonal entry ``(i, i, 0)`` for every item of the matrix: joined to a user's
    rating of ``i`` it marks ``i`` as seen without adding to any score, so excluding seen items needs
    no second pass over the ratings and no extra shuffle.
    """
    v = sim_scaled.select("item_1", "item_2", "val")
    if symmetric:
        v = v.unionByName(v.select(F.col("item_2").alias("item_1"), F.col("item_1").alias("item_2"), "val"))
    if markers:
        items = v.select(F.col("item_1").alias("_i")).union(v.select(F.col("item_2").alias("_i"))).distinct()
        v = v.unionByName(items.select(F.col("_i").alias("item_1"), F.col("_i").alias("item_2"), F.lit(0).alias("val")))
    return v


def _figures(weights: DataFrame, lengths: DataFrame, hot_user_degree: int | None) -> tuple[int, Narrow, int, tuple[int, int]]:
    """Bytes of the packed matrix with rows ``(item_1, _len, _low, _high, _least, _most)`` in its narrowest form, that
    form, number of partial products, and ``(sum of squared degrees, hot users)``: all that the plan depends on, in one
    action over one row per item and one per user."""
    raters = weights.groupBy("item_id").agg(F.count("*").alias("_raters"))
    rows = lengths.join(raters, F.col("item_1") == F.col("item_id"), "left")
    sizes = {(c, v): f"size_{c}_{v}" for c in (8, 4) for v in (4, 1)}
    kind = lengths.schema["_low"].dataType
    numbers = isinstance(kind, INTEGRAL)   # other items have no range
    low, high = (F.col(c) if numbers else F.lit(None) for c in ("_low", "_high"))
    by_item = rows.agg(F.sum(F.col("_len") * F.col("_raters")).alias("b"), *[F.sum(packed_bytes(F.col("_len"), k)).alias(n) for k, n in sizes.items()],
                       F.min(low).cast("long").alias("low"), F.max(high).cast("long").alias("high"),
                       F.min("_least").cast("long").alias("least"), F.max("_most").cast("long").alias("most"))
    degree = weights.groupBy("user_id").agg(F.count("*").alias("_deg"))
    hot = F.col("_deg") > F.lit(hot_user_degree) if hot_user_degree is not None else F.lit(False)
    by_user = degree.agg(F.sum(F.col("_deg") * F.col("_deg")).alias("a"), F.count(F.when(hot, True)).alias("b"))
    item, user = by_item.unionByName(by_user, allowMissingColumns=True).take(2)
    form = narrow(kind, item["low"], item["high"], item["least"], item["most"])
    return int(item[sizes[form.widths]] or 0), form, int(item["b"] or 0), (int(user["a"] or 0), int(user["b"] or 0))


def _branches(weights: DataFrame, v: DataFrame, *, max_broadcast_bytes: int,
              hot_user_degree: int | None, max_hot_keys: int, partitions: int | None,
              user_partitioned: bool = False, how: str = "inner", skip_zero_weights: bool = True,
              seen: bool = False, rows_per_task: int | None = None, packed: DataFrame | None = None, kept: int = 0) -> list[DataFrame]:
    """Scores ``(user_id, item_id, score[, _seen])`` per branch (ordinary users; hot users).
    ``skip_zero_weights`` drops ratings of weight 0 before the join (they add nothing, but would
    create zero-score rows); ranking keeps them so that they still mark their item as seen and keep
    their user present. ``packed`` gives the matrix ``v`` as packed arrays where the caller has them. ``rows_per_task``
    by default is ``SCORING_ROWS_PER_TASK``, and ``BLOCK_ROWS_PER_TASK`` in cells; of a cell's scores a user's ``kept``
    best ones are sent on (0: none)."""
    spark = weights.sparkSession
    nonzero = F.col("w") != 0 if skip_zero_weights else F.lit(True)
    lengths = (v.groupBy("item_1").agg(F.count("*").alias("_len"), F.min("item_2").alias("_low"), F.max("item_2").alias("_high"),
                                       F.min("val").alias("_least"), F.max("val").alias("_most")) if packed is None
               else packed.select("item_1", F.size("cols").alias("_len"), F.array_min("cols").alias("_low"), F.array_max("cols").alias("_high"),
                                  F.array_min("vals").alias("_least"), F.array_max("vals").alias("_most")))
    size, form, products, degrees = _figures(weights.filter(nonzero), lengths, hot_user_degree)
    if size > max_broadcast_bytes:
        w = weights.filter(nonzero)
        return blocked_scores(w, v, plan_blocks(w, v, rows_per_task=rows_per_task or BLOCK_ROWS_PER_TASK, cells=partitions, max_hot_keys=max_hot_keys, kept=kept), how=how, seen=seen)
    # `size` bytes, computed from the row lengths. Written first: the scoring stage then reads it as it stands.
    rows = F.broadcast(materialize(pack_matrix(form.entries(v)), "packed_matrix") if packed is None else form.arrays(packed))
    # Sized by the exact number of partial products, not by the weight rows shuffled.
    parts = partitions or partitions_for(spark, products, rows_per_task or SCORING_ROWS_PER_TASK)
    split = (split_hot_keys(weights, "user_id", min_degree=hot_user_degree, max_hot_keys=max_hot_keys, known=degrees)
             if hot_user_degree is not None else HotSplit(weights, None, 0))
    # Explicit partition count: the exchange carries only weight rows but the work after it is
    # the product, so AQE must not coalesce this stage by its small shuffle size. Input that is
    # already bucketed by user keeps its partitioning and needs no exchange at all.
    wn = split.normal if user_partitioned else split.normal.repartition(parts, "user_id")
    out = [packed_scores(wn.filter(nonzero), rows, how=how, seen=seen, form=form)]
    if split.hot is not None:
        wh = (split.hot.withColumn("_chunk", chunk_of("item_id"))
              .repartition(parts, "user_id", "_chunk").drop("n_chunks"))
        out.append(packed_scores(wh.filter(nonzero), rows, how=how, seen=seen, form=form))
    return out


def _pad(ranked: DataFrame, k: int) -> DataFrame:
    """Every user's list: the positive scores among their ``k`` best rows, then zero-score
    fillers with the lowest ids not listed, up to ``k`` entries.

    ``ranked`` holds each user's first ``k`` rows of all scored rows (seen markers and rows with
    a NULL item included), so every user is present and no join with a user list is needed. One
    user's rows (at most ``k``) are collected; ``m < k`` listed ids leave at least ``k - m`` free
    ids in ``0..k-1``, so the fillers come from a per-user array of ``k`` ids rather than a cross
    join with an id range.
    """
    entry = "struct<item_id:bigint,score:bigint>"
    got = ranked.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "item_id", "score"))).alias("_top"))
    listed = F.transform(F.filter(F.col("_top"), lambda e: e["score"] > 0),
                         lambda e: F.struct(e["item_id"].alias("item_id"), e["score"].alias("score")))
    listed = listed.cast(f"array<{entry}>")
    m = F.size(listed)
    free = F.array_except(F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint")),
                          F.transform(listed, lambda e: e["item_id"]))
    fill = F.transform(F.slice(free, 1, F.greatest(F.lit(k) - m, F.lit(0))),
                       lambda x: F.struct(x.alias("item_id"), F.lit(0).cast("bigint").alias("score")))
    out = got.select("user_id", F.posexplode(F.concat(listed, fill.cast(f"array<{entry}>"))).alias("_pos", "_e"))
    return out.select("user_id", F.col("_e.item_id").alias("item_id"), F.col("_e.score").alias("score"),
                      (F.col("_pos") + 1).cast("int").alias("rank"))


def user_scores(weights: DataFrame, sim_scaled: DataFrame, *, symmetric: bool = False,
                max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                hot_user_degree: int | None = DEFAULT_HOT_USER_DEGREE,
                max_hot_keys: int = DEFAULT_MAX_HOT_KEYS, partitions: int | None = None,
                user_partitioned: bool = False, rows_per_task: int | None = None) -> DataFrame:
    """``(user_id, item_id, score)`` for every item reached through at least one similarity row
    (zero scores included). ``weights``: ``(user_id, item_id, w)``; ``sim_scaled``:
    ``(item_1, item_2, val)``, upper triangle unless ``symmetric`` mirrors it."""
    v = _matrix(sim_scaled, symmetric)
    branches = _branches(weights.select("user_id", "item_id", "w"), v,
                         max_broadcast_bytes=max_broadcast_bytes, hot_user_degree=hot_user_degree,
                         max_hot_keys=max_hot_keys, partitions=partitions, user_partitioned=user_partitioned,
                         rows_per_task=rows_per_task)
    out = branches[0]
    for b in branches[1:]:
        out = out.unionByName(b)
    return out


def user_scores_packed(weights: DataFrame, packed_rows: DataFrame, *, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                       hot_user_degree: int | None = DEFAULT_HOT_USER_DEGREE, max_hot_keys: int = DEFAULT_MAX_HOT_KEYS,
                       partitions: int | None = None, rows_per_task: int | None = None) -> DataFrame:
    """``user_scores`` from a stored packed matrix ``(item_1, packed)`` (``similarity_rows``, packed text): each rating
    meets the packed row of its item, which is parsed to two arrays and expanded behind the join only."""
    arrays = unpack_arrays(packed_rows, "item_1")
    at = arrays.select("item_1", "vals", F.posexplode("cols").alias("_at", "item_2"))
    v = at.select("item_1", "item_2", F.get("vals", F.col("_at")).alias("val"))
    branches = _branches(weights.select("user_id", "item_id", "w"), v, packed=arrays, max_broadcast_bytes=max_broadcast_bytes,
                         hot_user_degree=hot_user_degree, max_hot_keys=max_hot_keys, partitions=partitions, rows_per_task=rows_per_task)
    return reduce(DataFrame.unionByName, branches)


def recommend(ratings: DataFrame, sim: DataFrame, k: int = 100, *, symmetric: bool = False,
              exclude_seen: bool = False, pad_zeros: bool = False,
              max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
              hot_user_degree: int | None = DEFAULT_HOT_USER_DEGREE,
              max_hot_keys: int = DEFAULT_MAX_HOT_KEYS, partitions: int | None = None,
              user_partitioned: bool = False, rows_per_task: int | None = None) -> DataFrame:
    """Top-``k`` items per user: ``(user_id, item_id, score, rank)``.

    ``ratings``: ``(user_id, item_id, rating)``; ``sim``: ``(item_1, item_2, similarity)``, best
    passed as a written table (its row lengths decide the broadcast).
    Defaults follow the original job: the similarity matrix is used as stored (upper triangle),
    rated items may be recommended, order is score descending then item id ascending. Only
    positive scores are listed unless ``pad_zeros`` fills every user's list to ``k`` with
    zero-score ids in ascending order, as the original fixed-length output does.
    ``symmetric`` mirrors the matrix first; ``exclude_seen`` drops items the user rated.
    ``user_partitioned=True`` declares ``ratings`` hash partitioned by user (a table bucketed by
    ``user_id``), which removes the exchange of the scoring stage.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if pad_zeros and exclude_seen:
        raise ValueError("pad_zeros pads with the lowest ids and does not combine with exclude_seen")
    weights = scaled_ratings(ratings)
    v = _matrix(scaled_similarity(sim), symmetric, markers=exclude_seen)
    branches = _branches(weights, v, max_broadcast_bytes=max_broadcast_bytes,
                         hot_user_degree=hot_user_degree, max_hot_keys=max_hot_keys, partitions=partitions,
                         user_partitioned=user_partitioned, rows_per_task=rows_per_task, seen=exclude_seen,
                         how="left" if pad_zeros else "inner", kept=k,
                         skip_zero_weights=not (exclude_seen or pad_zeros))
    result = None
    for scores in branches:
        if pad_zeros:
            top = _pad(top_k_per_user(scores, k), k)
        else:
            s = scores.filter(F.col("score") > 0)
            if exclude_seen:
                s = s.filter(~F.col("_seen"))
            top = top_k_per_user(s, k).select("user_id", "item_id", "score", "rank")
        result = top if result is None else result.unionByName(top)
    return result


def format_recommendations(recs: DataFrame) -> DataFrame:
    """``(user_id, recs)`` with ``recs = '\\t(item\\tscore)...'`` in rank order (at most k per user)."""
    entries = F.array_sort(F.collect_list(F.struct("rank", "item_id", "score")))
    return recs.groupBy("user_id").agg(entries.alias("_e")).select(
        "user_id", pack_entries("_e", "item_id", "score").alias("recs"))
