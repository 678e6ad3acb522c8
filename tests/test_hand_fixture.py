"""The worked hand fixture: pair statistics, both similarity modes, scaling, scores and lists."""

import math

import pytest

from conftest import rows
from corate.operators import (
    co_ratings,
    item_similarity,
    pair_stats,
    recommend,
    scaled_ratings,
    scaled_similarity,
    user_scores,
)

RATINGS = [(1, 1, 5.0), (1, 2, 3.0), (1, 3, 0.5), (2, 1, 4.0), (2, 2, 2.5), (2, 4, 1.5),
           (3, 1, 0.5), (3, 2, 4.0), (3, 3, 0.5), (3, 4, 4.0)]


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.createDataFrame(RATINGS, "user_id bigint, item_id bigint, rating double")


def test_pair_stats_truncated(ratings):
    got = {(r.item_1, r.item_2): (r.n, r.num, r.d1, r.d2) for r in pair_stats(co_ratings(ratings)).collect()}
    assert got == {(1, 2): (3, 27, 41, 31), (1, 3): (2, 2, 25, 0), (1, 4): (2, 8, 16, 18),
                   (2, 3): (2, 3, 25, 0), (2, 4): (2, 19, 22, 18), (3, 4): (1, 2, 0, 16)}


def test_similarity_truncated_and_exact(ratings):
    t = {(r.item_1, r.item_2): r.similarity for r in item_similarity(ratings, min_support=1).collect()}
    assert t[(1, 2)] == 27 / (math.sqrt(41) * math.sqrt(31))
    assert t[(1, 2)] == pytest.approx(0.7573401631618394, abs=0)
    assert t[(1, 3)] == math.inf and t[(2, 3)] == math.inf and t[(3, 4)] == math.inf
    assert t[(1, 4)] == pytest.approx(0.47140452079103173, abs=0)
    assert t[(2, 4)] == pytest.approx(0.9547859244962514, abs=0)
    e = {(r.item_1, r.item_2): r.similarity
         for r in item_similarity(ratings, min_support=1, truncate=False).collect()}
    assert e[(1, 2)] == pytest.approx(0.7520154737286145, rel=1e-15)
    assert e[(1, 3)] == pytest.approx(0.773957299203321, rel=1e-15)
    assert e[(2, 3)] == pytest.approx(0.9899494936611665, rel=1e-15)
    assert e[(3, 4)] == pytest.approx(1.0, rel=1e-15)


def test_zero_over_zero_is_nan(spark):
    r = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.5)], "user_id bigint, item_id bigint, rating double")
    (row,) = item_similarity(r, min_support=1).collect()
    assert math.isnan(row.similarity)
    (s,) = scaled_similarity(item_similarity(r, min_support=1)).collect()
    assert s.val == 0


def test_scaling(ratings):
    sim = item_similarity(ratings, min_support=2)
    got = {(r.item_1, r.item_2): r.val for r in scaled_similarity(sim).collect()}
    assert got == {(1, 2): 75, (1, 3): 2147483647, (1, 4): 47, (2, 3): 2147483647, (2, 4): 95}
    w = {(r.user_id, r.item_id): r.w for r in scaled_ratings(ratings).collect()}
    assert w[(1, 1)] == 10 and w[(1, 3)] == 1 and w[(2, 2)] == 5


def test_scores_are_64_bit(ratings):
    sim = item_similarity(ratings, min_support=2)
    got = {(r.user_id, r.item_id): r.score
           for r in user_scores(scaled_ratings(ratings), scaled_similarity(sim)).collect()}
    assert got == {(1, 2): 750, (1, 3): 34359738352, (1, 4): 1040,
                   (2, 2): 600, (2, 3): 27917287411, (2, 4): 851,
                   (3, 2): 75, (3, 3): 19327352823, (3, 4): 807}


def test_default_and_unseen_lists(ratings):
    sim = item_similarity(ratings, min_support=2)
    top = [r.item_id for r in recommend(ratings, sim, 100).filter("user_id = 1").orderBy("rank").collect()]
    assert top == [3, 4, 2]
    unseen = rows(recommend(ratings, sim, 100, exclude_seen=True).filter("user_id = 1"), "item_id")
    assert unseen == [(4,)]


def test_padded_list(ratings):
    sim = item_similarity(ratings, min_support=2)
    out = recommend(ratings, sim, 6, pad_zeros=True).filter("user_id = 1").orderBy("rank").collect()
    assert [(r.item_id, r.score, r.rank) for r in out] == [
        (3, 34359738352, 1), (4, 1040, 2), (2, 750, 3), (0, 0, 4), (1, 0, 5), (5, 0, 6)]


def test_symmetric_uses_mirrored_rows(ratings):
    sim = item_similarity(ratings, min_support=2)
    sym = {(r.user_id, r.item_id): r.score for r in recommend(ratings, sim, 100, symmetric=True).collect()}
    # user 1 rated item 2 (w=6): with the mirrored row 2 -> 1 (75) item 1 now scores 6*75 + 1*inf_scaled
    assert sym[(1, 1)] == 6 * 75 + 1 * 2147483647


def test_padded_list_for_user_without_scores(spark, ratings):
    # user 4 rated only item 4, whose upper-triangle row is empty: the whole list is padding
    extra = spark.createDataFrame([(4, 4, 3.0)], "user_id bigint, item_id bigint, rating double")
    r = ratings.unionByName(extra)
    sim = item_similarity(ratings, min_support=2)
    out = recommend(r, sim, 4, pad_zeros=True).filter("user_id = 4").orderBy("rank").collect()
    assert [(x.item_id, x.score, x.rank) for x in out] == [(0, 0, 1), (1, 0, 2), (2, 0, 3), (3, 0, 4)]
    assert recommend(r, sim, 4).filter("user_id = 4").count() == 0


def test_edge_inputs(spark, ratings):
    empty_sim = spark.createDataFrame([], "item_1 bigint, item_2 bigint, similarity double, n_ratings bigint")
    assert recommend(ratings, empty_sim, 5).count() == 0
    padded = recommend(ratings, empty_sim, 3, pad_zeros=True)
    assert rows(padded, "user_id", "item_id", "score") == [(u, i, 0) for u in (1, 2, 3) for i in (0, 1, 2)]
    assert recommend(ratings, empty_sim, 5, exclude_seen=True).count() == 0
    no_ratings = ratings.limit(0)
    assert item_similarity(no_ratings, min_support=1).count() == 0
    assert recommend(no_ratings, item_similarity(ratings, min_support=2), 5).count() == 0
    with pytest.raises(ValueError):
        recommend(ratings, empty_sim, 0)


def test_negative_ratings_rejected_in_truncated_mode(spark):
    r = spark.createDataFrame([(1, 1, 2.0), (1, 2, -1.5), (2, 1, 1.0), (2, 2, 3.0)],
                              "user_id bigint, item_id bigint, rating double")
    with pytest.raises(Exception, match="non-negative"):
        item_similarity(r, min_support=1).collect()
    (row,) = item_similarity(r, min_support=1, truncate=False).collect()   # exact cosine is defined
    # item 1: (u1 2.0, u2 1.0); item 2: (u1 -1.5, u2 3.0): dot = 2.0*-1.5 + 1.0*3.0 = 0
    assert row.similarity == 0.0
