"""Composed jobs: load, similarity, recommend and export, each stage written before the next.

Every job writes under a run-stamped directory (``<out>/run=<id>``) so a rerun never overwrites the
tables it reads, and a lost executor only recomputes from the last written stage.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from corate.functions.scalars import DEFAULT_TITLE_MARKER
from corate.operators.catalog import filter_title
from corate.operators.dedupe import latest_by_key, upsert_items, upsert_ratings
from corate.operators.recommend import recommend
from corate.operators.similarity import item_similarity
from corate.operators.vectors import scaled_ratings, scaled_similarity, similarity_rows, user_vectors
from corate.sinks.tables import write_observed
from corate.sinks.writers import (
    export_items,
    run_path,
    write_bucketed,
    write_packed,
    write_recommendations,
    write_similarity,
    write_table,
)
from corate.sources.readers import read_items, read_split, split_log


@dataclass
class LoadResult:
    items: str
    ratings: str
    rejects: str
    ratings_table: str | None = None  # catalog name when the ratings are bucketed by user
    counts: dict = field(default_factory=dict)  # rows written, as the writes counted them


def load_job(spark: SparkSession, items_csv: str, ratings_csv: str, out_dir: str, *,
             existing_items: str | None = None, existing_ratings: str | None = None,
             marker: str | None = DEFAULT_TITLE_MARKER, run_id: str | int | None = None,
             user_buckets: int | None = None) -> LoadResult:
    """Read an item CSV and a rating log, keep items whose title carries ``marker``, and upsert both
    into the tables at ``existing_*`` (if given), writing new tables under ``out_dir/run=<id>``.
    Ratings: incoming replaces stored, newest timestamp wins within the log.

    ``user_buckets`` writes the ratings bucketed by user and registers them in the catalog
    (``LoadResult.ratings_table``); similarity and scoring read them with
    ``user_partitioned=True`` and skip their user exchanges."""
    base = run_path(out_dir, run_id)
    items = read_items(spark, items_csv).select("item_id", "title")
    if marker is not None:
        items = filter_title(items, marker)
    items = latest_by_key(items, ["item_id"], ["title"])
    if existing_items:
        items = upsert_items(spark.read.parquet(existing_items), items)
    log = split_log(spark, ratings_csv, f"{base}/log")   # the log is read once
    good, rejects = read_split(spark, f"{base}/log")
    if existing_ratings:
        good = upsert_ratings(spark.read.parquet(existing_ratings), good, ["ts"])
    else:
        good = latest_by_key(good, ["user_id", "item_id"], ["ts", "rating"])
    counts = {"log_lines": log["rows"], "rejected_lines": log["rejected"]}
    ratings_table = None
    if user_buckets:
        ratings_table = f"ratings_run_{base.rsplit('=', 1)[-1]}"
        write_bucketed(good, ratings_table, f"{base}/ratings", user_buckets, by="user_id")
    else:
        counts["ratings"] = write_observed(good, f"{base}/ratings")["rows"]
    counts["items"] = write_observed(items, f"{base}/items")["rows"]
    return LoadResult(items=f"{base}/items", ratings=f"{base}/ratings", rejects=write_table(rejects, f"{base}/rejects"),
                      ratings_table=ratings_table, counts=counts)


def similarity_job(ratings: DataFrame, out_dir: str, *, items: DataFrame | None = None,
                   min_support: int = 20, truncate: bool = True, run_id: str | int | None = None,
                   text: bool = True, user_partitioned: bool = False, ordered_text: bool | str = False,
                   unique: bool = False) -> str:
    """Item similarity written as a table (and as ``m1 m2<TAB>sim n`` text, in key order across
    files with ``ordered_text``, see ``write_similarity``); returns the run path. ``unique`` as in
    ``item_similarity``."""
    base = run_path(out_dir, run_id)
    sim = item_similarity(ratings, items, min_support=min_support, truncate=truncate,
                          user_partitioned=user_partitioned, unique=unique)
    write_table(sim, f"{base}/similarity")
    if text:
        spark = ratings.sparkSession
        write_similarity(spark.read.parquet(f"{base}/similarity"), f"{base}/similarity_text",
                         ordered=ordered_text)
    return base


def recommend_job(ratings: DataFrame, similarity: DataFrame, out_dir: str, *, k: int = 100,
                  symmetric: bool = False, exclude_seen: bool = False, pad_zeros: bool = False,
                  packed_text: bool = True, run_id: str | int | None = None,
                  user_partitioned: bool = False) -> str:
    """Scaled similarity rows, user vectors and top-``k`` recommendations (table and text)."""
    spark = ratings.sparkSession
    base = run_path(out_dir, run_id)
    if packed_text:
        write_packed(similarity_rows(scaled_similarity(similarity)), "item_1", f"{base}/similarity_rows")
        write_packed(user_vectors(scaled_ratings(ratings)), "user_id", f"{base}/user_vectors")
    recs = recommend(ratings, similarity, k, symmetric=symmetric, exclude_seen=exclude_seen,
                     pad_zeros=pad_zeros, user_partitioned=user_partitioned)
    write_table(recs, f"{base}/recommendations")
    write_recommendations(spark.read.parquet(f"{base}/recommendations"), f"{base}/recommendations_text")
    return base


def export_job(spark: SparkSession, items_csv: str, out_dir: str, *, marker: str = DEFAULT_TITLE_MARKER,
               run_id: str | int | None = None) -> str:
    """Items whose title carries ``marker``, re-exported as quoted CSV."""
    return export_items(read_items(spark, items_csv), f"{run_path(out_dir, run_id)}/items", marker)
