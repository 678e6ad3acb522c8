"""The command line drives the jobs end to end on the hand fixture files."""

import os

from conftest import rows
from corate.cli import main

MOVIES = 'movieId,title,genres\n1,"A, The (2001)",x\n2,B (2002),y\n3,C (2003),z\n4,D (2004),w\n5,E (1999),v\n'
RATINGS = ("userId,movieId,rating,timestamp\n1,1,5.0,1\n1,2,3.0,1\n1,3,0.5,1\n2,1,4.0,1\n2,2,2.5,1\n"
           "2,4,1.5,1\n3,1,0.5,1\n3,2,4.0,1\n3,3,0.5,1\n3,4,4.0,1\n")


def test_cli_pipeline(spark, tmp_path):
    d = str(tmp_path)
    for name, text in (("movies.csv", MOVIES), ("ratings.csv", RATINGS)):
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    ratings = main(["load", "--items", f"{d}/movies.csv", "--ratings", f"{d}/ratings.csv",
                    "--out", f"{d}/t", "--run-id", "1"])
    sim = main(["similarity", "--ratings", ratings, "--out", f"{d}/s", "--min-support", "2", "--run-id", "1"])
    recs = main(["recommend", "--ratings", f"{d}/ratings.csv", "--similarity", f"{sim}/similarity_text",
                 "--similarity-text", "--out", f"{d}/r", "--k", "3", "--run-id", "1"])
    top = spark.read.parquet(f"{recs}/recommendations").filter("user_id = 1").orderBy("rank")
    assert [r.item_id for r in top.collect()] == [3, 4, 2]
    os.makedirs(f"{d}/incoming")
    with open(f"{d}/incoming/ratings.csv", "w") as f:
        f.write(RATINGS)
    table = main(["ingest", "--source", f"{d}/incoming", "--table", f"{d}/events", "--checkpoint", f"{d}/ck"])
    from corate.streaming import current_ratings
    assert current_ratings(spark, table).count() == 10

    out = main(["export", "--items", f"{d}/movies.csv", "--out", f"{d}/e", "--run-id", "1"])
    exported = spark.read.option("header", True).option("escape", '"').csv(out)
    assert rows(exported, "item_id") == [("1",), ("2",), ("3",), ("4",)]
