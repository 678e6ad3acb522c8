"""End-to-end jobs on the hand fixture files."""

import os

from conftest import rows
from corate.plans.jobs import export_job, load_job, recommend_job, similarity_job

MOVIES = 'movieId,title,genres\n1,"A, The (2001)",x\n2,B (2002),y\n3,C (1999),z\n4,D (2004),w\n'
RATINGS = ("userId,movieId,rating,timestamp\n1,1,5.0,1\n1,2,3.0,1\n1,3,0.5,1\n2,1,4.0,1\n2,2,2.5,1\n"
           "2,4,1.5,1\n3,1,0.5,1\n3,2,4.0,1\n3,3,0.5,1\n3,4,4.0,1\n3,4,1.0,0\nbad\n")


def test_load_similarity_recommend(spark, tmp_path):
    d = str(tmp_path)
    for name, text in (("movies.csv", MOVIES), ("ratings.csv", RATINGS)):
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    loaded = load_job(spark, f"{d}/movies.csv", f"{d}/ratings.csv", f"{d}/tables", run_id=1)
    assert rows(spark.read.parquet(loaded.items), "item_id") == [(1,), (2,), (4,)]
    ratings = spark.read.parquet(loaded.ratings)
    assert ratings.count() == 10 and rows(ratings.filter("user_id = 3 and item_id = 4"), "rating") == [(4.0,)]
    assert spark.read.parquet(loaded.rejects).count() == 2

    sim_base = similarity_job(ratings, f"{d}/sim", min_support=2, run_id=1)
    assert spark.read.text(f"{sim_base}/similarity_text").count() == 5
    rec_base = recommend_job(ratings, spark.read.parquet(f"{sim_base}/similarity"), f"{d}/rec", run_id=1)
    recs = spark.read.parquet(f"{rec_base}/recommendations")
    assert [r.item_id for r in recs.filter("user_id = 1").orderBy("rank").collect()] == [3, 4, 2]
    lines = {r.value.split("\t")[0]: r.value for r in spark.read.text(f"{rec_base}/recommendations_text").collect()}
    assert lines["1"] == "1\t\t(3\t34359738352)\t(4\t1040)\t(2\t750)"

    again = load_job(spark, f"{d}/movies.csv", f"{d}/ratings.csv", f"{d}/tables", run_id=2,
                     existing_items=loaded.items, existing_ratings=loaded.ratings)
    assert spark.read.parquet(again.ratings).count() == 10

    bucketed = load_job(spark, f"{d}/movies.csv", f"{d}/ratings.csv", f"{d}/tables", run_id=3, user_buckets=4)
    rb = spark.table(bucketed.ratings_table)
    b_sim = similarity_job(rb, f"{d}/sim", min_support=2, run_id=3, user_partitioned=True)
    b_rec = recommend_job(rb, spark.read.parquet(f"{b_sim}/similarity"), f"{d}/rec", run_id=3,
                          user_partitioned=True, packed_text=False)
    assert rows(spark.read.parquet(f"{b_rec}/recommendations")) == rows(recs)

    out = export_job(spark, f"{d}/movies.csv", f"{d}/export", run_id=1)
    assert sorted(r.title for r in spark.read.option("header", True).option("escape", '"').csv(out).collect()) == [
        "A, The (2001)", "B (2002)", "D (2004)"]
