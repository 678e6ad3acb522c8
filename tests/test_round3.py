"""Plans for large data: packed and blocked products, clustered and bucketed tables, key filters, incremental
statistics, one-line packed rows, one-pass logs, text order."""

from __future__ import annotations

import datetime
import os
import random
import re
import sys

import pytest
from pyspark.sql import functions as F

from corate.bridge import ratings
from corate.cli import main
from corate.operators import (
    add_stats,
    apply_changes,
    co_ratings,
    item_similarity,
    key_filter,
    pack_matrix,
    pair_stats,
    pair_stats_delta,
    rating_pair_stats,
    plan_blocks,
    rating_changes,
    rating_lookup,
    ratings_of_item,
    recommend,
    scaled_similarity,
    semi_join,
    similarity_rows,
    user_scores,
    user_scores_packed,
)
from corate.operators.matrix import blocked_scores, packed_bytes, packed_scores
from corate.operators.similarity import _figures, _stripes_by_user
from corate.plans.catalogue import q_pair_stats_incremental
from corate.plans.jobs import load_job
from corate.plans.skew import SCORING_ROWS_PER_TASK
from corate.session import materialize
from corate.sinks import (
    create_bucket_table,
    read_bucket_table,
    run_path,
    upsert_bucket_table,
    write_clustered,
    write_observed,
    write_packed_lines,
    write_similarity,
)
from corate.sources import read_packed, read_packed_entries, read_split, split_log
from corate.sources.readers import classified, rating_fields

from conftest import SF_SMALL, rows

RATING = "user_id long, item_id long, rating double"


def _matrix(spark, seed=1, users=60, items=40):
    r = random.Random(seed)
    w = [(u, i, r.randint(0, 10)) for u in range(users) for i in range(items) if r.random() < 0.3]
    w += [(1000, i, 3) for i in range(items)]
    v = [(i, j, r.randint(-5, 100)) for i in range(items) for j in range(i + 1, items + 20) if r.random() < 0.6]
    return spark.createDataFrame(w, "user_id long, item_id long, w int"), spark.createDataFrame(v, "item_1 long, item_2 long, val int"), w, v


def _brute(w, v):
    out = {}
    for u, i, x in w:
        for a, j, y in v:
            if a == i and x:
                out[u, j] = out.get((u, j), 0) + x * y
    return sorted((*k, s) for k, s in out.items())


# -- packed and blocked product -----------------------------------------------------------------

def test_packed_and_blocked_scores_equal_brute_force(spark):
    w, v, lw, lv = _matrix(spark)
    want = _brute(lw, lv)
    assert rows(user_scores(w, v)) == want
    assert rows(user_scores(w, v, max_broadcast_bytes=0)) == want
    assert rows(user_scores(w, v, max_broadcast_bytes=0, rows_per_task=200, partitions=7)) == want
    text = similarity_rows(v, segment_width=8)
    assert rows(user_scores_packed(w, text)) == want == rows(user_scores_packed(w, text, max_broadcast_bytes=0))


def test_long_matrix_rows_are_packed_in_pieces(spark):
    v = spark.range(1, 1001).select(F.lit(0).cast("long").alias("item_1"), F.col("id").alias("item_2"), F.lit(2).alias("val"))
    v = v.unionByName(spark.createDataFrame([(5, 6, 7)], "item_1 long, item_2 long, val int"))
    p = pack_matrix(v, max_entries=100)
    sizes = [(r.item_1, len(r.cols)) for r in p.collect()]
    assert sum(n for i, n in sizes if i == 0) == 1000 and max(n for _, n in sizes) < 200 and len(sizes) == 11
    w = spark.createDataFrame([(1, 0, 3), (1, 5, 1), (2, 9, 1)], "user_id long, item_id long, w int")
    assert rows(packed_scores(w, F.broadcast(p))) == [(1, 6, 13), *[(1, i, 6) for i in range(1, 1001) if i != 6]] or \
        sorted(rows(packed_scores(w, F.broadcast(p)))) == sorted([(1, i, 13 if i == 6 else 6) for i in range(1, 1001)])


def test_packed_size_is_that_of_the_broadcast(spark):
    v = spark.range(200).select((F.col("id") % 3).alias("item_1"), F.col("id").alias("item_2"), F.lit(1).alias("val"))
    p = pack_matrix(v)
    told = p.agg(F.sum(packed_bytes(F.size("cols")))).first()[0]
    w = spark.createDataFrame([(1, 0, 3)], "user_id long, item_id long, w int")
    df = packed_scores(w, F.broadcast(p))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    sizes = []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if node.nodeName().startswith("BroadcastExchange"):
            sizes.append(node.metrics().apply("dataSize").value())
        if "QueryStage" in node.nodeName():
            walk(node.plan())
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(plan)
    assert len(sizes) == 1 and 200 * 12 <= told <= sizes[0] + 64 * 3 + 2048  # a page of its own besides the rows


@pytest.mark.parametrize("base,top,limit", [(0, 100, 6), (10**12, 100, 6), (-(10**18), 100, 6), (0, (1 << 31) - 1, 9), (0, -129, 9)])
def test_a_matrix_is_broadcast_in_its_narrowest_form(spark, monkeypatch, base, top, limit):
    """5 bytes an entry, or 8 where a value needs an int: a limit between them and 12 still gives a broadcast."""
    spread = lambda c: F.col(c) + F.lit(base)
    w, v, lw, lv = _matrix(spark)
    v = v.unionByName(spark.createDataFrame([(0, 70, top)], v.schema))
    n = v.count()
    module = sys.modules["corate.operators.recommend"]
    monkeypatch.setattr(module, "plan_blocks", lambda *a, **k: pytest.fail("not broadcast"))
    want = sorted((u, j + base, s) for u, j, s in _brute(lw, [*lv, (0, 70, top)]))
    heads = 40 * 140                       # of the rows
    w, v = w.withColumn("item_id", spread("item_id")), v.select(spread("item_1").alias("item_1"), spread("item_2").alias("item_2"), "val")
    assert rows(user_scores(w, v, max_broadcast_bytes=n * limit + heads)) == want


def test_a_matrix_of_far_apart_items_stays_wide(spark):
    w = spark.createDataFrame([(1, 1, 2), (1, 2, 3)], "user_id long, item_id long, w int")
    v = spark.createDataFrame([(1, 2, 5), (1, 1 << 40, 7), (2, 1 << 40, 1)], "item_1 long, item_2 long, val int")
    for limit in (1 << 20, 0):
        assert rows(user_scores(w, v, max_broadcast_bytes=limit)) == [(1, 2, 10), (1, 1 << 40, 17)]


def _partition_rows(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_a_hot_item_is_spread_over_the_cells(spark):
    """3,000 raters x a row of 3,000 entries: 9 million products of one item."""
    w = spark.range(3000).select(F.col("id").alias("user_id"), F.lit(0).cast("long").alias("item_id"), F.lit(1).alias("w"))
    v = spark.range(1, 3001).select(F.lit(0).cast("long").alias("item_1"), F.col("id").alias("item_2"), F.lit(1).alias("val"))
    b = plan_blocks(w, v)
    assert b.products == 9_000_000 and b.cut is None and b.users > 1 and b.columns > 1
    parts = blocked_scores(w, v, b)
    assert len(parts) == 1
    sizes = _partition_rows(parts[0])
    assert sum(sizes) == 9_000_000 and max(sizes) <= SCORING_ROWS_PER_TASK


def test_a_user_who_fills_a_cell_is_cut_by_item(spark):
    w = spark.range(3000).select(F.lit(7).cast("long").alias("user_id"), F.col("id").alias("item_id"), F.lit(2).alias("w"))
    w = w.unionByName(spark.createDataFrame([(8, 5, 3)], "user_id long, item_id long, w int"))
    v = spark.range(3000 * 100).select((F.col("id") % 3000).alias("item_1"), F.floor(F.col("id") / 3000).alias("item_2"), F.lit(1).alias("val"))
    b = plan_blocks(w, v, rows_per_task=20_000, cells=64)
    assert b.cut is not None
    plain, cut = blocked_scores(w, v, b)
    assert rows(cut) == [(7, j, 6000) for j in range(100)] and rows(plain) == [(8, j, 3) for j in range(100)]


def test_blocked_products_are_not_shuffled(spark):
    w, v, _, _ = _matrix(spark)
    b = plan_blocks(w, v)
    blocked_scores(w, v, b)[0].createOrReplaceTempView("_blocked")
    plan = spark.sql("EXPLAIN FORMATTED SELECT * FROM _blocked").collect()[0][0]
    tree = plan.split("\n\n")[0]
    assert len(re.findall(r"\bExchange\b", tree)) == 2, tree   # one for each input, none behind the join


def test_blocked_scores_copy_both_sides_a_few_times(spark, monkeypatch):
    """3 million products, which cells of 512 K half filled would cut into 12."""
    w = spark.range(300_000).select((F.col("id") % 3000).alias("user_id"), (F.col("id") % 100).alias("item_id"), F.lit(1).alias("w"))
    v = spark.range(1000).select((F.col("id") % 100).alias("item_1"), (F.col("id") + 100).alias("item_2"), F.lit(1).alias("val"))
    seen = []
    monkeypatch.setattr(sys.modules["corate.operators.recommend"], "plan_blocks", lambda *a, **k: seen.append(plan_blocks(*a, **k)) or seen[-1])
    assert user_scores(w, v, max_broadcast_bytes=0).agg(F.sum("score")).first()[0] == 3_000_000
    assert seen[0].products == 3_000_000 and seen[0].cells <= 9


def test_cells_are_sized_by_scores(spark):
    """2.5 million products that are summed to 50 thousand scores: cells of 10 thousand products would be 250."""
    w = spark.range(50_000).select(F.floor(F.col("id") / 50).alias("user_id"), (F.col("id") % 50).alias("item_id"), F.lit(1).alias("w"))
    v = spark.range(2500).select((F.col("id") % 50).alias("item_1"), F.floor(F.col("id") / 50).alias("item_2"), F.lit(2).alias("val"))
    b = plan_blocks(w, v, rows_per_task=20_000)
    assert b.products == 2_500_000 and b.cut is None and b.cells <= 16
    (scores,) = blocked_scores(w, v, b)
    assert rows(scores) == [(u, j, 100) for u in range(1000) for j in range(50)]


@pytest.mark.parametrize("option", [{}, {"symmetric": True}, {"exclude_seen": True}, {"pad_zeros": True}])
def test_blocked_recommendations_equal_the_broadcast_ones(spark, option):
    r = random.Random(5)
    ratings = spark.createDataFrame([(u, i, r.randint(1, 10) / 2) for u in range(40) for i in range(25) if r.random() < 0.4], RATING)
    sim = materialize(item_similarity(ratings, min_support=2), "sim")
    want = rows(recommend(ratings, sim, 7, **option))
    assert want == rows(recommend(ratings, sim, 7, max_broadcast_bytes=0, rows_per_task=300, partitions=9, **option))


def test_one_action_before_the_main_job(spark, monkeypatch):
    """Everything the plan of scoring depends on comes from one collect."""
    w, v, _, _ = _matrix(spark)
    ran = []
    for name in ("collect", "count", "first", "take", "toLocalIterator"):
        real = getattr(type(w), name)
        monkeypatch.setattr(type(w), name, lambda self, *a, _real=real, _name=name, **k: (ran.append(_name), _real(self, *a, **k))[1])
    user_scores(w, v)
    assert ran.count("collect") == 1   # a write of the packed rows follows
    del ran[:]
    item_similarity(w.withColumn("rating", F.col("w").cast("double")), min_support=2, unique=True)
    assert len([x for x in ran if x != "take"]) <= 4 and ran.count("first") == 2   # item counts, user degrees


# -- clustered tables and lookups -----------------------------------------------------------------

def _scanned(df):
    """Rows that the Parquet scans of an executed frame passed on."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name.startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_lookups_skip_row_groups_of_clustered_tables(spark, tmp_path):
    n = 40_000
    r = spark.range(n).select(F.pmod(F.col("id") * 7919, F.lit(n)).alias("user_id"), (F.col("id") % 200).alias("item_id"), (F.col("id") % 10 / 2).alias("rating"))
    plain = str(tmp_path / "plain")
    r.repartition(4).write.parquet(plain)
    path = write_clustered(r, str(tmp_path / "clustered"), rows_per_file=10_000, rows_per_group=1_000)
    t = spark.read.parquet(path)
    assert t.count() == n and rows(ratings_of_item(t, 17)) == rows(ratings_of_item(spark.read.parquet(plain), 17))
    assert sum(_scanned(ratings_of_item(t, 17))) <= 2_000 and sum(_scanned(ratings_of_item(spark.read.parquet(plain), 17))) == n
    some = r.filter("user_id in (5, 77, 1234)").select("user_id", "item_id")
    keys = some.unionByName(spark.createDataFrame([(5, 199), (n + 1, 3), (None, 3)], "user_id long, item_id long"))
    assert sorted(map(str, rating_lookup(t, keys).collect())) == sorted(map(str, rating_lookup(spark.read.parquet(plain), keys).collect()))
    assert sum(_scanned(rating_lookup(t, materialize(keys, "keys")).filter("rating is not null"))) <= 8_000
    # The Bloom filter on the second key answers where the leading key is not given.
    assert sum(_scanned(t.filter(F.col("user_id") == 1234))) < n / 2


def test_key_filter_passes_all_keys_and_few_others(spark):
    keys = spark.range(0, 3000, 3).select(F.col("id").alias("a"), (F.col("id") * 5).alias("b")).unionByName(
        spark.createDataFrame([(None, 1), (2, None)], "a long, b long"))
    d = spark.range(30_000).select(F.col("id").alias("a"), (F.col("id") * 5).alias("b")).unionByName(spark.createDataFrame([(None, 1)], "a long, b long"))
    passed = d.filter(key_filter(keys, ["a", "b"], 1000))
    exact = d.join(keys, ["a", "b"], "left_semi")
    assert exact.exceptAll(passed).count() == 0 and 1000 <= passed.count() < 1000 + 0.05 * 29_000
    full = d.filter(key_filter(keys, ["a", "b"], 1000, max_bits=64))   # hardly a filter, and still right
    assert exact.exceptAll(full).count() == 0
    assert rows(semi_join(d, keys, ["a", "b"], 1000)) == rows(exact) == rows(semi_join(d, keys, ["a", "b"], 1, max_bits=64))
    assert d.filter(key_filter(keys.limit(0), ["a"], 0)).count() == 0


def test_large_lookup_shuffles_few_ratings(spark):
    r = materialize(spark.range(20_000).select((F.col("id") % 1000).alias("user_id"), F.col("id").alias("item_id"), F.lit(1.0).alias("rating")), "r")
    keys = materialize(spark.range(0, 20_000, 40).select((F.col("id") % 1000).alias("user_id"), F.col("id").alias("item_id")), "k")
    df = rating_lookup(r, keys, max_broadcast_bytes=0)
    assert df.count() == 500 and df.filter("rating is null").count() == 0
    passed = r.filter(key_filter(keys, ["user_id", "item_id"], 500)).count()
    assert passed < 1500
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and "BroadcastNestedLoop" not in df._jdf.queryExecution().toString()


# -- bucketed upserts and incremental statistics --------------------------------------------------

def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_upsert_rewrites_only_the_buckets_of_the_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = RATING + ", ts long"
    base = [(u, i, 1.0, 5) for u in range(30) for i in range(5)]
    create_bucket_table(spark.createDataFrame(base, schema), path, ["user_id", "item_id"], 32)
    before = _files(path)
    batch = spark.createDataFrame([(3, 2, 4.0, 1), (3, 2, 3.0, 2), (99, 1, 5.0, 1)], schema)
    touched = upsert_bucket_table(spark, path, batch, ["user_id", "item_id"], ["ts"])
    after = _files(path)
    of = lambda files, b: {f for f in files if f"bucket_of_32={b}/" in f}
    assert 1 <= len(touched) <= 2
    for b in range(32):
        if b in touched:
            assert not of(before, b) & of(after, b)
        else:
            assert of(before, b) == of(after, b)
    want = {(u, i): (x, t) for u, i, x, t in base} | {(3, 2): (3.0, 2), (99, 1): (5.0, 1)}
    assert {(u, i): (x, t) for u, i, x, t in rows(read_bucket_table(spark, path))} == want
    upsert_bucket_table(spark, path, batch, ["user_id", "item_id"], ["ts"])   # repeated: no change
    assert {(u, i): (x, t) for u, i, x, t in rows(read_bucket_table(spark, path))} == want
    assert upsert_bucket_table(spark, path, batch.limit(0), ["user_id", "item_id"]) == []


@pytest.mark.parametrize("seed,degree", [(1, 2000), (2, 3), (3, 3)])
def test_incremental_statistics_equal_a_full_run(spark, seed, degree):
    r = random.Random(seed)
    old = [(u, i, r.randint(0, 10) / 2) for u in range(25) for i in range(12) if r.random() < 0.5]
    batch = [(r.randint(0, 30), r.randint(0, 14), r.randint(0, 10) / 2, r.randint(0, 2)) for _ in range(60)]
    batch += [(*old[0], 1), (*old[0], 1)]            # stays as it is
    existing, new = spark.createDataFrame(old, RATING), spark.createDataFrame(batch, RATING + ", ts long")
    changes = rating_changes(existing, new, ["ts"])
    merged = {(u, i): x for u, i, x in old}
    for u, i, x, _ in sorted(batch, key=lambda b: (b[3], b[2])):
        merged[u, i] = x
    after = apply_changes(existing, changes)
    assert rows(after, "user_id", "item_id", "rating") == sorted((u, i, x) for (u, i), x in merged.items())
    stats = add_stats(pair_stats(co_ratings(existing)), pair_stats_delta(existing, changes, hot_user_degree=degree))
    assert rows(stats, "item_1", "item_2", "n", "num", "d1", "d2") == rows(pair_stats(co_ratings(after)), "item_1", "item_2", "n", "num", "d1", "d2")
    assert pair_stats_delta(existing, changes.limit(0)).count() == 0


@pytest.mark.parametrize("degree", [2000, 3])
@pytest.mark.parametrize("wide", [1, 10 ** 12])
def test_incremental_statistics_with_missing_ratings_and_wide_ids(spark, degree, wide):
    """Also an added rating without a value counts; ids beyond the codes go as two lists."""
    r = random.Random(degree)
    stars = [None, 0.5, 2.0, 5.0]
    old = {(u, i * wide): r.choice(stars) for u in range(12) for i in range(12) if r.random() < 0.6}
    batch = {(u, i * wide): r.choice(stars) for u in range(0, 15, 2) for i in range(14) if r.random() < 0.4} | {(1, 13 * wide): None}
    frame = lambda d: spark.createDataFrame([(*k, x) for k, x in d.items()], RATING)
    changes = rating_changes(frame(old), frame(batch))
    assert rows(changes, "user_id", "item_id") == sorted(k for k, x in batch.items() if k not in old or old[k] != x)
    stats = add_stats(pair_stats(co_ratings(frame(old))), pair_stats_delta(frame(old), changes, hot_user_degree=degree), max_broadcast_bytes=0)
    cols = ["item_1", "item_2", "n", "num", "d1", "d2"]
    got, want = [{x[:2]: x[2:] for x in rows(s.fillna(0), *cols)} for s in (stats, pair_stats(co_ratings(frame(old | batch))))]
    assert got == want


def test_a_batch_meets_the_stored_ratings_in_one_exchange_each(spark, capsys, monkeypatch):
    monkeypatch.setattr("corate.operators.incremental.USER_SET_ROW_BYTES", 1 << 40)   # too many users to broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        existing = spark.createDataFrame([(u, i, 1.0) for u in range(9) for i in range(5)], RATING)
        batch = spark.createDataFrame([(u, i, 2.0) for u in range(9) for i in range(3, 7)], RATING)
        changes = rating_changes(existing, batch)
        changes.explain()
        plan = capsys.readouterr().out
        assert plan.count("Exchange") == 2 and plan.count("Join") == 1
        delta = pair_stats_delta(existing, changes.localCheckpoint())
        capsys.readouterr()
        delta.explain()
        plan = capsys.readouterr().out
        assert plan.count("Exchange hashpartitioning(user_id") == 1 and "Join" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_stripes_with_a_changed_rating_are_sent(spark):
    rated = [(u, i, 1.0) for u in range(4) for i in range(6)]
    marked = spark.createDataFrame([(*x, x[0] == 0 and x[1] == 2) for x in rated], RATING + ", _changed boolean")
    for codes in (_figures(marked, 9)[2], None):
        s = _stripes_by_user(codes.encoded(marked) if codes else marked, codes=codes)
        assert rows(s.select("item_1", F.size("_items"))) == [(0, 1), (1, 1), (2, 3)]


def test_stored_sums_and_changes_meet_without_an_exchange(spark, capsys, monkeypatch):
    df = q_pair_stats_incremental(spark, SF_SMALL)
    monkeypatch.setitem(add_stats.__kwdefaults__, "max_broadcast_bytes", 0)   # more changes than can be broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = q_pair_stats_incremental(spark, SF_SMALL)
        cols = ["item_1", "item_2", "n", "num", "d1", "d2"]
        assert rows(joined, *cols) == rows(df, *cols)
        capsys.readouterr()
        joined.explain()
        plan = capsys.readouterr().out
        assert "Bucketed: true" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sums_of_many_pairs_are_dealt_over_more_tasks_than_users(spark, capsys, monkeypatch):
    """Co-ratings that are all pairs of their own: a task's sums are bounded by them, not by the bytes of its lists."""
    monkeypatch.setattr("corate.operators.similarity.SUM_ENTRIES", 100, raising=False)
    df = spark.createDataFrame([(u, u * 10 + i, 3.0) for u in range(60) for i in range(10)], RATING)
    got = rating_pair_stats(df)
    assert rows(got, "item_1", "item_2", "n", "num", "d1", "d2") == sorted(
        (u * 10 + i, u * 10 + j, 1, 9, 9, 9) for u in range(60) for i in range(10) for j in range(i + 1, 10))
    got.explain()
    plan = capsys.readouterr().out
    tasks = {c: int(re.search(rf"Exchange hashpartitioning\({c}#\d+L?, (\d+)\)", plan).group(1)) for c in ("user_id", "item_1")}
    assert tasks["item_1"] == 30 and tasks["user_id"] < 30


# -- logs, uniqueness, guards ---------------------------------------------------------------------

def test_a_rating_logged_twice_counts_once(spark):
    log = [(u, i, float(x), t) for u in range(12) for i in (1, 2) for x, t in ((1, 1), (4, 2))]
    df = spark.createDataFrame(log, RATING + ", ts long")
    (row,) = item_similarity(df, min_support=5).collect()
    assert row.n_ratings == 12 and row.similarity == pytest.approx(1.0)
    assert item_similarity(df, min_support=13).count() == 0
    (row,) = item_similarity(df.drop("ts"), min_support=5, truncate=False).collect()
    assert row.n_ratings == 12


def test_negative_ratings_fail_truncated_statistics(spark):
    df = spark.createDataFrame([(1, 1, -1.0), (1, 2, 2.0)], RATING)
    with pytest.raises(Exception, match="non-negative"):
        pair_stats(co_ratings(df)).collect()
    assert pair_stats(co_ratings(df), truncate=False).first().num == -2.0


def test_a_log_is_split_in_one_pass(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "part-0").write_text('userId,movieId,rating\n1,2,3.5,7\n1,2\n"5","6","1.0"\n1,2,-1\n\n')
    out = str(tmp_path / "out")
    assert split_log(spark, str(tmp_path / "log"), out) == {"rows": 6, "rejected": 4}
    good, bad = read_split(spark, out)
    assert sorted(map(str, good.collect())) == sorted(map(str, spark.createDataFrame([(1, 2, 3.5, 7), (5, 6, 1.0, None)], RATING + ", ts long").collect()))
    assert sorted(r.reason for r in bad.collect()) == ["non_numeric", "out_of_range", "short", "short"]
    classified(rating_fields(spark.read.text(str(tmp_path / "log")))).createOrReplaceTempView("_split")
    plan = spark.sql("EXPLAIN SELECT * FROM _split").collect()[0][0]
    assert plan.count("FileScan text") == 1
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "f").write_text("")
    assert split_log(spark, str(tmp_path / "empty"), out)["rows"] == 0 and all(d.count() == 0 for d in read_split(spark, out))


def test_jobs_count_what_they_write(spark, tmp_path):
    assert write_observed(spark.range(10), str(tmp_path / "a"), top=F.max("id")) == {"rows": 10, "top": 9}
    (tmp_path / "i.csv").write_text("1,A (2001),x\n2,B (2002),x\n")
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "part-0").write_text("1,1,3.0,1\n1,1,4.0,2\n1,2,3.0,1\nbad\n")
    res = load_job(spark, str(tmp_path / "i.csv"), str(tmp_path / "r"), str(tmp_path / "o"))
    assert res.counts == {"log_lines": 4, "rejected_lines": 1, "ratings": 2, "items": 2}
    # A directory of log files without an ending is a log, a written table is a table.
    for k, source in enumerate((str(tmp_path / "r"), res.ratings)):
        base = main(["similarity", "--ratings", source, "--out", str(tmp_path / f"s{k}"), "--min-support", "1", "--run-id", "1"])
        assert rows(spark.read.parquet(f"{base}/similarity"), "item_1", "item_2", "n_ratings") == [(1, 2, 1)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        main(["similarity", "--ratings", str(tmp_path / "none"), "--out", str(tmp_path / "x")])


def test_run_paths_differ(tmp_path):
    paths = [run_path(str(tmp_path)) for _ in range(50)]
    assert len(set(paths)) == 50 and paths == sorted(paths)


# -- text ---------------------------------------------------------------------------------------

@pytest.mark.parametrize("partitions,hot", [(1, 1 << 20), (5, 1 << 20), (5, 300)])
def test_packed_lines(spark, tmp_path, monkeypatch, partitions, hot):
    monkeypatch.setattr("corate.sinks.writers.PIECE_ENTRIES", 64)
    wide = 1_000_000_007
    data = [(k * wide, c * wide, k + c) for k in range(20) for c in range(k * 3 + 1)] + [(-4, c * wide, c) for c in range(1000)] + [(wide * 50, 1, -2)]
    random.Random(3).shuffle(data)
    d = spark.createDataFrame(data, "k long, c long, v int").repartition(3)
    path = write_packed_lines(d, "k", "c", "v", str(tmp_path / "t"), partitions=partitions, hot_entries=hot)
    names = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    lines = [x for f in names for x in open(f"{path}/{f}").read().split("\n") if x]
    keys = [int(x.split("\t")[0]) for x in lines]
    want = {}
    for k, c, v in sorted(data):
        want[k] = want.get(k, "") + f"\t({c}\t{v})"
    assert keys == sorted(keys)
    got = {}
    for x in lines:
        k, _, rest = x.partition("\t")
        got[int(k)] = got.get(int(k), "") + rest
    assert got == want
    if hot > 1000:
        assert len(keys) == len(want)                       # one line per key
        assert {r.key: r.packed for r in read_packed(spark, path).collect()} == want
    else:
        assert keys.count(-4) > 1                           # dealt over files, in order
    assert rows(read_packed_entries(spark, path)) == sorted(data)
    assert read_packed(spark, write_packed_lines(d.limit(0), "k", "c", "v", str(tmp_path / "e"))).count() == 0


def test_similarity_text_in_text_order(spark, tmp_path):
    sim = spark.range(500).select((F.col("id") % 23).alias("item_1"), (F.col("id") + 23).alias("item_2"), F.lit(0.5).alias("similarity"), F.lit(3).cast("long").alias("n_ratings"))
    path = write_similarity(sim, str(tmp_path / "s"), ordered="text", partitions=4)
    names = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    keys = [x.split("\t")[0] for f in names for x in open(f"{path}/{f}").read().splitlines()]
    assert len(names) == 4 and len(keys) == 500 and keys == sorted(keys) and keys.index("1 116") < keys.index("1 24")


def test_bytes_of_scaled_rows_are_small(spark):
    """12 bytes an entry where a hash row per pair took 48."""
    s = spark.range(100_000).select((F.col("id") % 100).alias("item_1"), (F.col("id") + 100).alias("item_2"), F.lit(0.5).alias("similarity"))
    n = pack_matrix(scaled_similarity(s)).agg(F.sum(packed_bytes(F.size("cols")))).first()[0]
    assert n < 100_000 * 13


@pytest.mark.parametrize("degree,entries", [(2000, 1 << 20), (4, 1 << 20), (2000, 8), (4, 8)])
def test_pairs_summed_at_the_items_equal_the_self_join(spark, degree, entries):
    r = random.Random(degree + entries)
    data = [(u, i, r.choice([None, 0.5, 3.0, 4.5])) for u in [*range(30), None] for i in [*range(14), None] if r.random() < 0.6]
    df = spark.createDataFrame(data + data[:9], RATING)   # rows twice: each meets the others
    cols = ["item_1", "item_2", "n", "num", "d1", "d2"]
    for truncate in (True, False):
        want = rows(pair_stats(co_ratings(df, hot_user_degree=None), truncate), *cols)
        assert rows(rating_pair_stats(df, truncate=truncate, hot_user_degree=degree, entries=entries), *cols) == want


@pytest.mark.parametrize("kind,ids,stars,coded", [
    ("double", [-3, 0, 5, 9], [None, 0.0, 0.5, 126.5], True), ("float", [1, 2, 3, 4], [1.5, 4.5], True), ("double", [1, 2, 3, 4], [0.25, 1.0], False),
    ("double", [1, 2, 3, 4], [-0.5, 1.0], False), ("double", [1, 2, 1 << 40, 4], [1.0, 2.0], False), ("double", [1, 2, 3, 4], [127.0, 1.0], False),
    ("double", [1, 2, 3, 4], [float("nan"), 1.0], False), ("double", [(1 << 62) + i for i in range(4)], [1.0, 2.5], True)])
def test_half_stars_meet_as_one_int(spark, capsys, kind, ids, stars, coded):
    r = random.Random(len(stars))
    df = spark.createDataFrame([(u, i, r.choice(stars)) for u in range(20) for i in ids], f"user_id long, item_id long, rating {kind}")
    for degree in (2000, 2):
        got = rating_pair_stats(df, truncate=False, hot_user_degree=degree)
        cols = ["item_1", "item_2", "n", "num", "d1", "d2"]
        want = pair_stats(co_ratings(df, hot_user_degree=None), False)
        assert got.schema == want.schema and repr(rows(got, *cols)) == repr(rows(want, *cols))
        got.explain()
        assert ("_ratings" not in capsys.readouterr().out) == coded


@pytest.mark.parametrize("ids,upper", [([0, 1, 4095, 4096, (1 << 20) - 1], True), ([5, 6, 5 + (1 << 20)], False)])
def test_codes_below_three_bytes_travel_as_shorts(spark, capsys, ids, upper):
    r = random.Random(len(ids))
    stars = [0.5, 3.5, 5.0, 6.5]   # 4 bits
    df = spark.createDataFrame([(u, i, r.choice(stars)) for u in range(30) for i in ids if r.random() < 0.8], RATING)
    cols = ["item_1", "item_2", "n", "num", "d1", "d2"]
    want = rows(pair_stats(co_ratings(df, hot_user_degree=None)), *cols)
    for degree, entries in ((2000, 1 << 20), (2, 1 << 20), (2000, 8)):
        got = rating_pair_stats(df, hot_user_degree=degree, entries=entries)
        assert rows(got, *cols) == want
        got.explain()
        assert ("_upper" in capsys.readouterr().out) == upper


def test_users_are_counted_in_rows_of_a_count_only(spark):
    df = spark.createDataFrame([(u, i, 1.0) for u in range(9) for i in range(5)], RATING)
    known, most, codes = _figures(df, 4)
    assert known == (9 * 25, 9) and most == 5 and codes.split and (codes.low, codes.bits) == (0, 2)
    empty = _figures(df.filter("user_id < 0"), 4)
    assert empty == ((0, 0), 0, None)


def test_the_rating_is_not_shuffled_beside_its_event(spark, capsys):
    ratings(spark, SF_SMALL).explain()
    plan = capsys.readouterr().out
    assert "max_by" not in plan and plan.count("Exchange hashpartitioning(user_id") == 1


def test_what_cannot_change_a_rating_is_not_shuffled(spark, tmp_path):
    """Events alike up to the quantity have one rating, so the price after it stays out of the plan."""
    day = datetime.datetime(2020, 1, 1)
    lines = [(1, 5, 7, 1, 9.0, 2.0, day), (1, 5, 7, 1, 41.0, 1.0, day), (1, 5, 7, 1, 41.0, 3.0, day), (1, 6, 8, 1, None, 9.0, day), (1, 6, 9, 1, 3.0, None, day)]
    cols = "l_orderkey long, l_suppkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp"
    spark.createDataFrame(lines, cols).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, 4)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    df = ratings(spark, str(tmp_path))
    assert rows(df) == [(4, 5, 4.5), (4, 6, 0.5)]
    assert "l_extendedprice" not in df._jdf.queryExecution().executedPlan().toString()


def test_similarity_of_a_log_sorts_it_out_once(spark, capsys):
    log = spark.createDataFrame([(u, i, 0.5 * (i + 1), n) for u in range(25) for i in range(4) for n in range(2)], "user_id long, item_id long, rating double, ts long")
    sim = item_similarity(log, min_support=20)
    sim.explain()
    assert "max_by" not in capsys.readouterr().out and sim.count() == 6


def test_pairs_are_summed_without_an_exchange_of_pairs(spark, capsys):
    df = spark.createDataFrame([(u, i, 1.0) for u in range(9) for i in range(5)], RATING)
    rating_pair_stats(df).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning(item_1") == 1 and "Exchange hashpartitioning(item_1#" in plan
    assert "hashpartitioning(item_1#" in plan and ", item_2#" not in plan.split("Exchange hashpartitioning(item_1")[1].split("\n")[0]


def test_a_large_delta_is_added_in_one_exchange(spark):
    cols = ["item_1", "item_2", "n", "num", "d1", "d2"]
    kind = "item_1 long, item_2 long, n long, num long, d1 long, d2 long"
    stats = spark.createDataFrame([(1, 2, 3, 4, 5, 6), (1, 3, 1, 1, 1, 1), (2, 3, 7, 7, 7, 7)], kind)
    delta = spark.createDataFrame([(1, 2, -1, -2, 0, 1), (1, 3, -1, -1, -1, -1), (4, 5, 1, 2, 3, 4)], kind)
    want = [(1, 2, 2, 2, 5, 7), (2, 3, 7, 7, 7, 7), (4, 5, 1, 2, 3, 4)]
    for most in (0, 1 << 20):
        assert rows(add_stats(stats, delta, max_broadcast_bytes=most), *cols) == want
