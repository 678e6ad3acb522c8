"""Hot-key paths give the same results as the plain paths; plans have the intended shape."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, rows
from corate import bridge
from corate.operators import co_ratings, item_similarity, recommend, user_scores
from corate.operators import scaled_ratings, scaled_similarity
from corate.plans import split_hot_keys
from corate.session import materialize


@pytest.fixture(scope="module")
def data(spark):
    r = bridge.ratings(spark, SF_MID, written=True)
    s = materialize(item_similarity(r), "sim-test")
    return r, s


def test_hot_user_chunks_match_plain_self_join(data):
    r, _ = data
    plain = co_ratings(r, hot_user_degree=None)
    # threshold 40 makes about half the users hot, each cut into 2..6 chunks
    split = co_ratings(r, hot_user_degree=40)
    assert plain.count() == split.count()
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def _skewed(spark, n=3000):
    """User 0 owns every 7th row; everyone else rates once."""
    ids = spark.range(n)
    return ids.select(
        F.when(F.col("id") % 7 == 0, F.lit(0)).otherwise(F.col("id")).alias("user_id"),
        (F.col("id") % 500).alias("item_id"),
        ((F.col("id") % 10 + 1) / 2).alias("rating")).dropDuplicates(["user_id", "item_id"])


def test_hot_split_fixed_threshold(spark):
    r = _skewed(spark)
    n = r.count()
    for max_hot in (50, 0):          # broadcast hot table / shuffle-joined hot table
        s = split_hot_keys(r, "user_id", min_degree=100, max_hot_keys=max_hot)
        assert s.threshold == 100
        hot = s.hot.select("user_id", "n_chunks").distinct().collect()
        assert [(h.user_id, h.n_chunks) for h in hot] == [(0, 5)]       # 429 rows -> 5 chunks
        assert s.normal.count() + s.hot.count() == n
        assert s.normal.filter("user_id = 0").count() == 0


def test_hot_user_pairs_on_skewed_data(spark):
    r = _skewed(spark)
    plain = co_ratings(r, hot_user_degree=None)
    split = co_ratings(r, hot_user_degree=50)
    assert plain.count() == split.count() > 0
    assert plain.exceptAll(split).count() == 0


def test_hot_user_scoring_matches(data):
    r, s = data
    base = recommend(r, s, 10, hot_user_degree=None)
    hot = recommend(r, s, 10, hot_user_degree=40)
    assert rows(base) == rows(hot)


def test_shuffle_join_fallback_matches_broadcast(data):
    r, s = data
    w, v = scaled_ratings(r), scaled_similarity(s)
    bc = user_scores(w, v)
    blocked = user_scores(w, v, max_broadcast_bytes=0)
    cut = user_scores(w, v, max_broadcast_bytes=0, rows_per_task=20_000, partitions=12)
    assert rows(bc) == rows(blocked) == rows(cut)
    assert rows(recommend(r, s, 10)) == rows(recommend(r, s, 10, max_broadcast_bytes=0, rows_per_task=20_000, partitions=12))


def test_symmetric_is_invariant_to_item_renumbering(spark, data):
    r, _ = data
    perm = lambda c: (F.lit(1000) - F.col(c))  # noqa: E731  order-reversing renumbering
    r2 = r.select("user_id", perm("item_id").alias("item_id"), "rating")
    s1 = item_similarity(r)
    s2 = item_similarity(r2)
    a = recommend(r, s1, 1000, symmetric=True).select("user_id", "item_id", "score")
    b = recommend(r2, s2, 1000, symmetric=True).select("user_id", perm("item_id").alias("item_id"), "score")
    assert rows(a) == rows(b)


def test_exact_similarity_of_identical_columns_is_one(spark):
    data = [(u, i, float(1 + (u % 9)) / 2) for u in range(30) for i in (1, 2)]
    r = spark.createDataFrame(data, "user_id bigint, item_id bigint, rating double")
    (row,) = item_similarity(r, truncate=False).collect()
    assert row.similarity == pytest.approx(1.0, rel=1e-12)


def _plan(spark, df):
    df.createOrReplaceTempView("_plan_probe")
    return spark.sql("EXPLAIN FORMATTED SELECT * FROM _plan_probe").collect()[0][0]


def test_recommend_has_one_exchange(spark, data):
    r, s = data
    plan = _plan(spark, recommend(r, s, 10, hot_user_degree=None))
    tree = plan.split("\n\n")[0]
    assert tree.count("Exchange") - tree.count("BroadcastExchange") == 1
    assert "BroadcastHashJoin" in tree and "WindowGroupLimit" in tree


def test_similarity_self_join_reuses_one_user_exchange(spark, data, capsys):
    r, _ = data
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # the plan a large table gets
    try:
        df = item_similarity(r, hot_user_degree=None, unique=True)
        df.collect()
        capsys.readouterr()
        df.explain()
        final = capsys.readouterr().out.split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "isFinalPlan=true" in final
    assert "SortMergeJoin" in final and "ReusedExchange" in final
    # one user exchange (the other side reuses it) + one pair exchange after the partial aggregate
    assert final.count("Exchange hashpartitioning") - final.count("ReusedExchange") == 2
    assert "partial_sum" in final


def test_scan_prunes_columns(spark):
    plan = _plan(spark, bridge.ratings(spark, SF_MID))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_bucketed_ratings_remove_user_exchanges(spark, data, capsys, tmp_path):
    from corate.sinks import write_bucketed
    r, s = data
    write_bucketed(r, "ratings_by_user_test", str(tmp_path / "rb"), 8)
    rb = spark.table("ratings_by_user_test")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sim = item_similarity(rb, hot_user_degree=None, user_partitioned=True, unique=True)
        sim.collect()
        capsys.readouterr()
        sim.explain()
        final = capsys.readouterr().out.split("== Initial Plan ==")[0]
        assert "SortMergeJoin" in final
        assert final.count("Exchange hashpartitioning") == 1      # only the pair exchange
        assert "hashpartitioning(item_1" in final
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rec = recommend(rb, s, 10, user_partitioned=True)
    tree = _plan(spark, rec).split("\n\n")[0]
    assert tree.count("Exchange") == tree.count("BroadcastExchange")   # no shuffle at all
    assert rows(rec) == rows(recommend(r, s, 10))


def test_rare_item_pruning_is_exact(spark):
    from corate.operators.similarity import rated_at_least
    r = spark.createDataFrame(
        [(u, i, 1.0 + (u + i) % 4) for u in range(30) for i in range(6) if i < 3 or u % (i + 1) == 0],
        "user_id bigint, item_id bigint, rating double")
    counts = dict((x.item_id, x.c) for x in r.groupBy("item_id").agg(F.count("*").alias("c")).collect())
    for k in (1, 6, 8, 12, 31):
        kept = {x.item_id for x in rated_at_least(r, k).select("item_id").distinct().collect()}
        assert kept == {i for i, c in counts.items() if c >= k}
        a = item_similarity(r, min_support=k)
        b = item_similarity(r, min_support=k, prune_rare_items=False)
        assert rows(a) == rows(b)


def test_item_lookup_pushed_to_scan(spark):
    import __spark_entry__ as E
    plan = _plan(spark, E.queries()["ratings_of_item"](spark, SF_MID))
    scan = [line for line in plan.splitlines() if "PushedFilters" in line and "EqualTo(l_suppkey,3)" in line]
    assert scan, "item equality should reach the lineitem scan through the dedupe aggregate and join"


def test_hot_user_branch_partitions_by_chunk(spark, data):
    r, s = data
    plan = _plan(spark, recommend(r, s, 10, hot_user_degree=40))
    assert "Union" in plan.split("\n\n")[0]
    assert re.search(r"hashpartitioning\(user_id#\d+L, \d+\), REPARTITION_BY_NUM", plan)        # ordinary users
    assert re.search(r"hashpartitioning\(user_id#\d+L, _chunk#\d+, \d+\), REPARTITION_BY_NUM", plan)  # hot users
