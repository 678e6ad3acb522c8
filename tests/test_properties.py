"""Property tests of the generic operators against direct Python computations."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from corate.functions import java_int
from corate.operators import latest_by_key, pack_rows, top_k, unpack_rows

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

entries_st = st.dictionaries(st.tuples(st.integers(0, 5), st.integers(-3, 40)), st.integers(-10**9, 10**9),
                             min_size=1, max_size=40)


@SETTINGS
@given(entries=entries_st, width=st.sampled_from([1, 4, 16, 1 << 20]))
def test_pack_unpack_roundtrip(spark, entries, width):
    df = spark.createDataFrame([(k, c, v) for (k, c), v in entries.items()], "k bigint, c bigint, v bigint")
    packed = pack_rows(df, "k", "c", "v", segment_width=width)
    back = unpack_rows(packed, "k", col="c", val="v")
    assert rows(back) == sorted((k, c, v) for (k, c), v in entries.items())
    # every segment holds only columns of its window, in ascending order
    for r in packed.collect():
        cols = [int(x.split("\t")[0]) for x in r.packed.strip("\t()").split(")\t(")]
        assert cols == sorted(cols) and all(math.floor(c / width) == r.segment for c in cols)


versions_st = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 30), st.integers(0, 3), st.text("ab", max_size=3)),
                       min_size=1, max_size=40)


@SETTINGS
@given(versions=versions_st)
def test_latest_by_key(spark, versions):
    df = spark.createDataFrame(versions, "k bigint, t bigint, tie bigint, v string")
    got = {r.k: (r.t, r.tie, r.v) for r in latest_by_key(df, ["k"], ["t", "tie", "v"]).collect()}
    want = {}
    for k, t, tie, v in versions:
        if k not in want or (t, tie, v) > want[k]:
            want[k] = (t, tie, v)
    assert got == want


scores_st = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50), st.integers(-5, 5)), min_size=1, max_size=60,
                     unique_by=lambda t: (t[0], t[1]))


@SETTINGS
@given(scores=scores_st, k=st.integers(1, 7))
def test_top_k_with_ties(spark, scores, k):
    df = spark.createDataFrame(scores, "g bigint, item bigint, s bigint")
    got = rows(top_k(df, ["g"], [F.col("s").desc(), F.col("item").asc()], k), "g", "item", "s", "rank")
    want = []
    for g in sorted({x[0] for x in scores}):
        ordered = sorted((x for x in scores if x[0] == g), key=lambda x: (-x[2], x[1]))[:k]
        want += [(g, item, s, i + 1) for i, (_, item, s) in enumerate(ordered)]
    assert got == sorted(want)


def test_java_int_rules(spark):
    vals = [0.0, 2.9, -2.9, 99.99999, float("nan"), float("inf"), float("-inf"), 3e9, -3e9, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(java_int("x")).collect()]
    assert got == [0, 2, -2, 99, 0, 2147483647, -2147483648, 2147483647, -2147483648, None]


def test_user_renumbering_leaves_similarity_unchanged(spark):
    from conftest import SF_SMALL
    from corate import bridge
    from corate.operators import item_similarity
    r = bridge.ratings(spark, SF_SMALL)
    renumbered = r.select((F.lit(10**9) - F.col("user_id") * 7).alias("user_id"), "item_id", "rating")
    for truncate in (True, False):
        a = item_similarity(r, min_support=5, truncate=truncate)
        b = item_similarity(renumbered, min_support=5, truncate=truncate)
        assert a.count() > 0 and rows(a) == rows(b)
