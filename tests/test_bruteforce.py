"""Random small rating sets: Spark results equal a direct pure-Python computation."""

import math
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from corate.operators import item_similarity, recommend

HALF_STARS = [x / 2 for x in range(1, 11)]

ratings_st = st.dictionaries(
    keys=st.tuples(st.integers(0, 7), st.integers(0, 9)),
    values=st.sampled_from(HALF_STARS),
    min_size=1, max_size=45,
)


def brute_similarity(r, min_support, truncate):
    by_user = defaultdict(dict)
    for (u, i), x in r.items():
        by_user[u][i] = x
    acc = defaultdict(lambda: [0, 0, 0, 0])
    for items in by_user.values():
        for a in items:
            for b in items:
                if a < b:
                    s = acc[(a, b)]
                    f = math.floor if truncate else (lambda v: v)
                    s[0] += 1
                    s[1] += f(items[a] * items[b])
                    s[2] += f(items[a] * items[a])
                    s[3] += f(items[b] * items[b])
    out = {}
    for pair, (n, num, d1, d2) in acc.items():
        if n < min_support:
            continue
        den = math.sqrt(d1) * math.sqrt(d2)
        if den == 0:
            if truncate:
                out[pair] = (math.nan if num == 0 else math.inf, n)
        else:
            out[pair] = (float(num) / den, n)
    return out


def java_int(x):
    if math.isnan(x):
        return 0
    if x >= 2147483647:
        return 2147483647
    return int(x)


def brute_recommend(r, sim, k, symmetric=False, exclude_seen=False, pad=False):
    val = {p: java_int(100 * s) for p, (s, _) in sim.items()}
    if symmetric:
        val.update({(b, a): v for (a, b), v in list(val.items())})
    rows = defaultdict(list)
    for (a, b), v in val.items():
        rows[a].append((b, v))
    users = defaultdict(dict)
    for (u, i), x in r.items():
        users[u][i] = java_int(x * 2)
    out = {}
    for u, w in users.items():
        score = defaultdict(int)
        for i, wi in w.items():
            for j, v in rows.get(i, []):
                score[j] += wi * v
        cand = [(j, s) for j, s in score.items() if s > 0 and not (exclude_seen and j in w)]
        cand.sort(key=lambda t: (-t[1], t[0]))
        top = cand[:k]
        if pad:
            listed = {j for j, _ in top}
            top += [(j, 0) for j in range(k) if j not in listed][: k - len(top)]
        out[u] = top
    return out


def _df(spark, r):
    return spark.createDataFrame([(u, i, x) for (u, i), x in r.items()],
                                 "user_id bigint, item_id bigint, rating double")


def _same_float(a, b):
    return (math.isnan(a) and math.isnan(b)) or a == b


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(r=ratings_st, min_support=st.integers(1, 3), truncate=st.booleans())
def test_similarity_matches_brute_force(spark, r, min_support, truncate):
    got = {(x.item_1, x.item_2): (x.similarity, x.n_ratings)
           for x in item_similarity(_df(spark, r), min_support=min_support, truncate=truncate,
                                    hot_user_degree=3).collect()}
    want = brute_similarity(r, min_support, truncate)
    assert got.keys() == want.keys()
    for p in want:
        assert got[p][1] == want[p][1]
        if truncate:
            assert _same_float(got[p][0], want[p][0])
        else:
            assert math.isclose(got[p][0], want[p][0], rel_tol=1e-12)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(r=ratings_st, k=st.integers(1, 6),
       option=st.sampled_from(["plain", "symmetric", "unseen", "padded", "symmetric+unseen", "symmetric+padded"]),
       fallback=st.booleans())
def test_recommend_matches_brute_force(spark, r, k, option, fallback):
    df = _df(spark, r)
    sim_df = item_similarity(df, min_support=1)
    sim = {(x.item_1, x.item_2): (x.similarity, x.n_ratings) for x in sim_df.collect()}
    kw = {"symmetric": "symmetric" in option, "exclude_seen": "unseen" in option, "pad_zeros": "padded" in option}
    got = defaultdict(list)
    plan = {"max_broadcast_bytes": 0, "rows_per_task": 16} if fallback else {"hot_user_degree": 3}
    for x in recommend(df, sim_df, k, **plan, **kw).orderBy("user_id", "rank").collect():
        got[x.user_id].append((x.item_id, x.score))
    want = brute_recommend(r, sim, k, symmetric=kw["symmetric"], exclude_seen=kw["exclude_seen"], pad=kw["pad_zeros"])
    assert {u: v for u, v in want.items() if v} == dict(got)
