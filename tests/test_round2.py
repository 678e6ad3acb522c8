"""Results that must not depend on size, layout or row order."""

from __future__ import annotations

from corate.cli import main
from corate.operators.catalog import rating_lookup
from corate.operators.dedupe import latest_by_key, upsert_ratings
from corate.operators.similarity import rated_at_least
from corate.plans.jobs import load_job
from corate.sources.readers import item_rejects, read_items, read_ratings

from conftest import rows


def test_rare_items_go_at_every_size(spark):
    r = spark.createDataFrame([(u, 1, 3.0) for u in range(5)] + [(1, 2, 1.0)], "user_id long, item_id long, rating double")
    for limit in (0, 1 << 20):
        assert rows(rated_at_least(r, 3, max_broadcast_bytes=limit).select("item_id").distinct()) == [(1,)]


def test_headerless_files_keep_their_first_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,A,x\n2,B,y\n")
    (tmp_path / "b.csv").write_text("movieId,title,genres\n3,C,x\n4,D,y\n")
    assert [r[0] for r in rows(read_items(spark, str(tmp_path)))] == [1, 2, 3, 4]


def test_item_rejects(spark, tmp_path):
    (tmp_path / "a.csv").write_text('movieId,title,genres\n1,"A, B",x\n14\nx2,C,y\n')
    assert [r[0] for r in rows(read_items(spark, str(tmp_path)))] == [1]
    assert sorted((r.id, r.reason) for r in item_rejects(spark, str(tmp_path)).collect()) == [
        ("14", "short"), ("movieId", "non_numeric"), ("x2", "non_numeric")]


def test_quoted_and_impossible_ratings(spark, tmp_path):
    (tmp_path / "r.csv").write_text('"9","2676","1.0","970889359"\n1,2,NaN\n1,2,Infinity\n1,2,-4.0\n"1","2"\n3,4,2.5\n')
    good, rejects = read_ratings(spark, str(tmp_path), with_timestamp=True)
    assert rows(good, "user_id", "item_id", "rating") == [(3, 4, 2.5), (9, 2676, 1.0)]
    assert sorted(r.reason for r in rejects.collect()) == ["out_of_range"] * 3 + ["short"]


def test_ties_and_older_batches(spark):
    schema = "user_id long, item_id long, rating double, ts long"
    old = spark.createDataFrame([(1, 1, 5.0, 9), (1, 2, 4.0, 1)], schema)
    for batch in ([(1, 1, 2.0, 3), (1, 1, 3.0, 3)], [(1, 1, 3.0, 3), (1, 1, 2.0, 3)]):
        got = upsert_ratings(old, spark.createDataFrame(batch, schema), ["ts"])
        assert rows(got) == [(1, 1, 3.0, 3), (1, 2, 4.0, 1)]


def test_lookup_is_the_same_by_either_plan(spark):
    r = spark.createDataFrame([(u, i, u + i / 2) for u in range(5) for i in range(3)], "user_id long, item_id long, rating double")
    keys = spark.createDataFrame([(1, 1), (1, 1), (9, 9)], "user_id long, item_id long")
    want = [("1", "1", "1.5"), ("1", "1", "1.5"), ("9", "9", "None")]
    for limit in (0, 1 << 20):
        assert sorted(tuple(map(str, x)) for x in rating_lookup(r, keys, max_broadcast_bytes=limit).collect()) == want


def test_load_and_filtered_similarity_from_a_log(spark, tmp_path):
    (tmp_path / "items.csv").write_text("1,A (2001),x\n1,B (2001),x\n2,C (2002),x\n3,D (1999),x\n")
    lines = [f"{u},{i},{4.0},{t}" for u in range(12) for i in (1, 2, 3) for t in (1, 2)]
    (tmp_path / "ratings.csv").write_text("\n".join(lines) + "\n")
    res = load_job(spark, str(tmp_path / "items.csv"), str(tmp_path / "ratings.csv"), str(tmp_path / "out"), run_id=1)
    assert rows(spark.read.parquet(res.items)) == [(1, "B (2001)"), (2, "C (2002)")]
    for support, want in ((20, []), (12, [(1, 2, 12)])):  # each rating is logged twice but counts once
        base = main(["similarity", "--ratings", str(tmp_path / "ratings.csv"), "--items", str(tmp_path / "items.csv"),
                     "--out", str(tmp_path / f"s{support}"), "--min-support", str(support), "--run-id", "1"])
        assert rows(spark.read.parquet(f"{base}/similarity"), "item_1", "item_2", "n_ratings") == want


def test_similarity_rejects_and_last_token(spark, tmp_path):
    from corate.sources import read_packed_entries, read_similarity, similarity_rejects

    (tmp_path / "s").write_text("1 2\t0.5 20\n1 3\tabc 20\nbad\n\n1 4\tNaN 3\n")
    path = str(tmp_path / "s")
    assert sorted(r["item_2"] for r in read_similarity(spark, path).collect()) == [2, 4]
    assert sorted(map(tuple, similarity_rejects(spark, path).collect())) == [
        ("", "short"), ("1 3\tabc 20", "non_numeric"), ("bad", "short")]
    (tmp_path / "p").write_text("7\t\t(5\t1)\t(6\t2)\t(5\t3)\n")
    got = read_packed_entries(spark, str(tmp_path / "p"), last_wins=True).collect()
    assert sorted((r["key"], int(r["col"]), int(r["val"])) for r in got) == [(7, 5, 3), (7, 6, 2)]
