"""Command line for the composed jobs (``spark-submit -m``-style: ``python -m corate <job> ...``).

    python -m corate load --items movies.csv --ratings ratings.csv --out /shared/tables
    python -m corate similarity --ratings /shared/tables/run=1/ratings --out /shared/sim [--min-support 20]
    python -m corate recommend --ratings /shared/tables/run=1/ratings --similarity /shared/sim/run=1/similarity \\
        --out /shared/recs [--k 100 --pad-zeros]
    python -m corate export --items movies.csv --out /shared/export
    python -m corate ingest --source /shared/incoming --table /shared/rating_events \
        --checkpoint /shared/ckpt/ingest [--every "1 minute"]

Rating inputs are written tables or logs: a path whose files are not Parquet is read as a log.
Outputs go under ``<out>/run=<id>``. The session comes from the environment (spark-submit).
"""

from __future__ import annotations

import argparse
import sys

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from corate.operators.catalog import filter_title
from corate.operators.dedupe import latest_by_key
from corate.plans.jobs import export_job, load_job, recommend_job, similarity_job
from corate.sources.readers import read_items, read_ratings, read_similarity
from corate.streaming.ingest import start_rating_ingest


def _session() -> SparkSession:
    # Under spark-submit the master and the shared checkpoint dir come from the submission.
    return SparkSession.getActiveSession() or SparkSession.builder.appName("corate").getOrCreate()


def _ratings(spark: SparkSession, path: str) -> DataFrame:
    """A written rating table, or a rating log as a table: one rating per user and item, the newest."""
    if not path.endswith((".csv", ".txt")):
        try:
            return spark.read.parquet(path)   # reads a footer only
        except (PySparkException, Py4JJavaError) as e:
            if not any(x in str(e) for x in ("is not a Parquet file", "UNABLE_TO_INFER_SCHEMA")):
                raise
    good, _ = read_ratings(spark, path, with_timestamp=True)
    return latest_by_key(good, ["user_id", "item_id"], ["ts", "rating"], values=["rating"])


def _similarity(spark: SparkSession, path: str, text: bool) -> DataFrame:
    return read_similarity(spark, path) if text else spark.read.parquet(path)


def main(argv: list[str] | None = None) -> str:
    p = argparse.ArgumentParser(prog="corate")
    sub = p.add_subparsers(dest="job", required=True)
    ld = sub.add_parser("load", help="load an item CSV and a rating log into tables")
    ld.add_argument("--items", required=True)
    ld.add_argument("--ratings", required=True)
    ld.add_argument("--out", required=True)
    ld.add_argument("--marker", default="(20")
    ld.add_argument("--user-buckets", type=int)
    ld.add_argument("--existing-items", help="item table to upsert into")
    ld.add_argument("--existing-ratings", help="rating table to upsert into")
    sm = sub.add_parser("similarity", help="item-to-item cosine similarity")
    sm.add_argument("--ratings", required=True)
    sm.add_argument("--out", required=True)
    sm.add_argument("--min-support", type=int, default=20)
    sm.add_argument("--exact", action="store_true", help="exact products instead of truncated ones")
    sm.add_argument("--ordered-text", action="store_true")
    sm.add_argument("--items", help="item CSV: only its items whose title carries --marker take part")
    sm.add_argument("--marker", default="(20")
    rc = sub.add_parser("recommend", help="top-k items per user")
    rc.add_argument("--ratings", required=True)
    rc.add_argument("--similarity", required=True)
    rc.add_argument("--similarity-text", action="store_true", help="similarity given as 'm1 m2<TAB>sim n' text")
    rc.add_argument("--out", required=True)
    rc.add_argument("--k", type=int, default=100)
    rc.add_argument("--symmetric", action="store_true")
    rc.add_argument("--exclude-seen", action="store_true")
    rc.add_argument("--pad-zeros", action="store_true")
    ex = sub.add_parser("export", help="re-export the items whose title carries the marker")
    ex.add_argument("--items", required=True)
    ex.add_argument("--out", required=True)
    ex.add_argument("--marker", default="(20")
    ig = sub.add_parser("ingest", help="stream rating log files into the rating event table")
    ig.add_argument("--source", required=True)
    ig.add_argument("--table", required=True)
    ig.add_argument("--checkpoint", required=True)
    ig.add_argument("--every", help="trigger interval for a continuous run (default: catch up and stop)")
    for s in (ld, sm, rc, ex):
        s.add_argument("--run-id")
    a = p.parse_args(argv)

    spark = _session()
    if a.job == "load":
        res = load_job(spark, a.items, a.ratings, a.out, marker=a.marker, run_id=a.run_id,
                       user_buckets=a.user_buckets, existing_items=a.existing_items,
                       existing_ratings=a.existing_ratings)
        out = res.ratings
    elif a.job == "similarity":
        items = filter_title(read_items(spark, a.items), a.marker) if a.items else None
        out = similarity_job(_ratings(spark, a.ratings), a.out, items=items, min_support=a.min_support,
                             truncate=not a.exact, run_id=a.run_id, ordered_text=a.ordered_text, unique=True)
    elif a.job == "recommend":
        out = recommend_job(_ratings(spark, a.ratings), _similarity(spark, a.similarity, a.similarity_text),
                            a.out, k=a.k, symmetric=a.symmetric, exclude_seen=a.exclude_seen,
                            pad_zeros=a.pad_zeros, run_id=a.run_id)
    elif a.job == "ingest":
        q = start_rating_ingest(spark, a.source, a.table, a.checkpoint,
                                available_now=a.every is None, processing_time=a.every)
        q.awaitTermination()
        out = a.table
    else:
        out = export_job(spark, a.items, a.out, marker=a.marker, run_id=a.run_id)
    print(out)
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
