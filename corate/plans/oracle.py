"""Independent ANSI SQL (DuckDB dialect) for every registered query, over the test tables.

Written from the query definitions, not generated from the Spark plans. Integer conversions use
``TRUNC`` because DuckDB's ``CAST(x AS INTEGER)`` rounds.
"""

from __future__ import annotations

from corate.plans import catalogue as C

_EV = """EV AS (
  SELECT o.o_custkey AS user_id, l.l_suppkey AS item_id, CEIL(l.l_quantity / 5) / 2 AS rating,
         l.l_shipdate, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, l.l_extendedprice
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

_RECENCY = ("l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, "
            "l_quantity DESC, l_extendedprice DESC")

_R = f"""R AS (
  SELECT user_id, item_id, rating FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, item_id ORDER BY {_RECENCY}) AS rn FROM EV)
  WHERE rn = 1)"""


def _co(src: str = "R") -> str:
    return f"""CO AS (
  SELECT a.user_id, a.item_id AS item_1, b.item_id AS item_2, a.rating AS rating_1, b.rating AS rating_2
  FROM {src} a JOIN {src} b ON a.user_id = b.user_id AND a.item_id < b.item_id)"""


_PS = """PS AS (
  SELECT item_1, item_2, COUNT(*) AS n,
         CAST(SUM(FLOOR(rating_1 * rating_2)) AS BIGINT) AS num,
         CAST(SUM(FLOOR(rating_1 * rating_1)) AS BIGINT) AS d1,
         CAST(SUM(FLOOR(rating_2 * rating_2)) AS BIGINT) AS d2
  FROM CO GROUP BY item_1, item_2)"""

_S = f"""S AS (
  SELECT item_1, item_2,
         CASE WHEN SQRT(d1) * SQRT(d2) = 0
              THEN CASE WHEN num = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST('Infinity' AS DOUBLE) END
              ELSE CAST(num AS DOUBLE) / (SQRT(d1) * SQRT(d2)) END AS similarity,
         n AS n_ratings
  FROM PS WHERE n >= {C.MIN_SUPPORT})"""

_SS = """SS AS (
  SELECT item_1, item_2,
         CASE WHEN isnan(similarity) THEN 0
              WHEN 100 * similarity >= 2147483647 THEN 2147483647
              ELSE CAST(TRUNC(100 * similarity) AS INTEGER) END AS val
  FROM S)"""

_W = """W AS (
  SELECT user_id, item_id, CAST(TRUNC(CAST(rating AS FLOAT) * CAST(2 AS FLOAT)) AS INTEGER) AS w FROM R)"""

_SIM_CTES = [_EV, _R, _co(), _PS, _S]


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _scores_cte(symmetric: bool = False) -> str:
    v = "SS"
    if symmetric:
        v = "(SELECT item_1, item_2, val FROM SS UNION ALL SELECT item_2, item_1, val FROM SS)"
    return f"""SC AS (
  SELECT w.user_id, v.item_2 AS item_id, CAST(SUM(CAST(w.w AS BIGINT) * v.val) AS BIGINT) AS score
  FROM W w JOIN {v} v ON w.item_id = v.item_1
  WHERE w.w <> 0
  GROUP BY w.user_id, v.item_2)"""


def _top(k: int, src: str = "SC", where: str = "score > 0") -> str:
    return f"""TOP AS (
  SELECT user_id, item_id, score, rank FROM (
    SELECT user_id, item_id, score,
           CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY score DESC, item_id ASC) AS INTEGER) AS rank
    FROM {src} WHERE {where}) WHERE rank <= {k})"""


_PACK = "chr(9) || '(' || CAST({c} AS VARCHAR) || chr(9) || CAST({v} AS VARCHAR) || ')'"


def _packed(key: str, col: str, val: str, src: str) -> str:
    entry = _PACK.format(c=col, v=val)
    return (f"SELECT {key}, CAST(FLOOR({col} / 1048576) AS BIGINT) AS segment, "
            f"string_agg({entry}, '' ORDER BY {col}) AS packed FROM {src} "
            f"GROUP BY {key}, CAST(FLOOR({col} / 1048576) AS BIGINT)")


def _recommend_sql(k: int, symmetric: bool = False, unseen: bool = False) -> str:
    ctes = [*_SIM_CTES, _SS, _W, _scores_cte(symmetric)]
    where = "score > 0"
    if unseen:
        where += " AND NOT EXISTS (SELECT 1 FROM R x WHERE x.user_id = SC.user_id AND x.item_id = SC.item_id)"
    return _with([*ctes, _top(k, where=where)], "SELECT user_id, item_id, score, rank FROM TOP")


def _padded_sql(k: int, text: bool = False) -> str:
    ctes = [*_SIM_CTES, _SS, _W, _scores_cte(), _top(k)]
    body = f"""SELECT user_id, item_id, score, rank FROM TOP
UNION ALL
SELECT user_id, item_id, CAST(0 AS BIGINT) AS score,
       CAST(m + ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY item_id) AS INTEGER) AS rank
FROM (
  SELECT u.user_id, g.i AS item_id, COALESCE(t.m, 0) AS m
  FROM (SELECT DISTINCT user_id FROM R) u
  CROSS JOIN (SELECT CAST(range AS BIGINT) AS i FROM range(0, {k})) g
  LEFT JOIN (SELECT user_id, COUNT(*) AS m FROM TOP GROUP BY user_id) t ON t.user_id = u.user_id
  WHERE NOT EXISTS (SELECT 1 FROM TOP x WHERE x.user_id = u.user_id AND x.item_id = g.i)
) c
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY item_id) <= {k} - m"""
    if text:
        body = (f"SELECT user_id, string_agg({_PACK.format(c='item_id', v='score')}, '' ORDER BY rank) AS recs "
                f"FROM ({body}) p GROUP BY user_id")
    return _with(ctes, body)


_CATALOG = f"CAT AS (SELECT s_suppkey AS item_id FROM supplier WHERE instr(s_name, '{C.CATALOG_MARKER}') > 0)"
_RC = "RC AS (SELECT * FROM R WHERE item_id IN (SELECT item_id FROM CAT))"


def oracle_sql() -> dict[str, str]:
    sim = _SIM_CTES
    q: dict[str, str] = {}
    q["item_similarity"] = _with(sim, "SELECT item_1, item_2, similarity, n_ratings FROM S")
    q["item_similarity_exact"] = _with([_EV, _R, _co(), f"""PX AS (
  SELECT item_1, item_2, COUNT(*) AS n, SUM(rating_1 * rating_2) AS num,
         SUM(rating_1 * rating_1) AS d1, SUM(rating_2 * rating_2) AS d2
  FROM CO GROUP BY item_1, item_2 HAVING COUNT(*) >= {C.MIN_SUPPORT})"""],
        """SELECT item_1, item_2, num / (SQRT(d1) * SQRT(d2)) AS similarity, n AS n_ratings
FROM PX WHERE SQRT(d1) * SQRT(d2) <> 0""")
    q["item_similarity_bucketed"] = q["item_similarity"]
    q["catalog_similarity"] = _with(
        [_EV, _R, _CATALOG, _RC, _co("RC"), _PS, _S], "SELECT item_1, item_2, similarity, n_ratings FROM S")
    q["pair_stats"] = _with([_EV, _R, _co(), _PS], "SELECT item_1, item_2, n, num, d1, d2 FROM PS")
    q["frequent_pairs"] = _with([_EV, _R, _co(), _PS],
                                f"SELECT item_1, item_2, n FROM PS WHERE n >= {C.FREQUENT_SUPPORT}")
    q["co_ratings"] = _with([_EV, _R, _CATALOG, _RC, _co("RC")],
                            "SELECT user_id, item_1, item_2, rating_1, rating_2 FROM CO")
    q["item_pairs"] = _with([_EV, _R, _co()], "SELECT DISTINCT item_1, item_2 FROM CO")
    q["ratings_in_catalog"] = _with([_EV, _R, _CATALOG, _RC], "SELECT user_id, item_id, rating FROM RC")
    q["latest_ratings"] = _with([_EV, _R], "SELECT user_id, item_id, rating FROM R")
    q["upsert_ratings"] = _with([_EV, f"""OLD AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, item_id ORDER BY {_RECENCY}) AS rn
                 FROM EV WHERE year(l_shipdate) < {C.UPSERT_OLD_BEFORE_YEAR}) WHERE rn = 1)""",
        f"""UPS AS (
  SELECT user_id, item_id, rating, {_RECENCY.replace(' DESC', '')}, 0 AS batch FROM OLD
  UNION ALL
  SELECT user_id, item_id, rating, {_RECENCY.replace(' DESC', '')}, 1 AS batch FROM EV
  WHERE year(l_shipdate) >= {C.UPSERT_OLD_BEFORE_YEAR})"""],
        f"""SELECT user_id, item_id, rating FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, item_id ORDER BY batch DESC, {_RECENCY}) AS rn FROM UPS)
WHERE rn = 1""")
    q["stream_ingest_ratings"] = q["upsert_ratings"]
    q["upsert_items"] = f"""SELECT item_id, title FROM (
  SELECT item_id, title, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY batch DESC) AS rn FROM (
    SELECT s_suppkey AS item_id, s_name AS title, 0 AS batch FROM supplier WHERE s_acctbal >= 0
    UNION ALL
    SELECT s_suppkey, s_name || '{C.RENAMED_SUFFIX}', 1 FROM supplier WHERE s_acctbal < 5000))
WHERE rn = 1"""
    q["title_marker_filter"] = (f"SELECT p_partkey AS item_id, p_name AS title FROM part "
                                f"WHERE instr(p_name, '{C.PART_MARKER}') > 0")
    q["title_year"] = "SELECT o_orderkey AS item_id, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders"
    q["ratings_of_item"] = _with([_EV, _R], f"SELECT user_id, rating FROM R WHERE item_id = {C.LOOKUP_ITEM}")
    q["rating_lookup"] = _with([_EV, _R], """SELECT k.user_id, k.item_id, r.rating
FROM (SELECT c_custkey AS user_id, CAST(c_nationkey AS BIGINT) AS item_id FROM customer) k
LEFT JOIN R r ON r.user_id = k.user_id AND r.item_id = k.item_id""")
    q["read_items"] = """SELECT s_suppkey AS item_id,
       s_name || ', "' || CAST(s_nationkey AS VARCHAR) || '"' AS title,
       CAST(s_nationkey AS VARCHAR) AS genres
FROM supplier"""
    q["export_items"] = (f"SELECT p_partkey AS item_id, p_name AS title, p_type AS genres FROM part "
                         f"WHERE instr(p_name, '{C.PART_MARKER}') > 0")
    q["read_ratings"] = _with([_EV, _R], "SELECT user_id, item_id, rating FROM R")
    q["reject_bad_ratings"] = _with([_EV, _R], f"""SELECT '{C.RATING_HEADER}' AS line, 'non_numeric' AS reason
UNION ALL
SELECT CAST(user_id AS VARCHAR) || ',' || CAST(item_id AS VARCHAR), 'short' FROM R WHERE rating = 5.0
UNION ALL
SELECT CAST(user_id AS VARCHAR) || ',' || CAST(item_id AS VARCHAR) || ',x', 'non_numeric' FROM R WHERE rating = 0.5""")
    q["similarity_text_roundtrip"] = _with(sim, "SELECT item_1, item_2, similarity, n_ratings FROM S")
    q["packed_text_roundtrip"] = _with([*sim, _SS], "SELECT item_1, item_2, val FROM SS")
    q["unpack_rows"] = q["packed_text_roundtrip"]
    q["scaled_similarity"] = q["packed_text_roundtrip"]
    q["table_dump"] = _with([_EV, _R, _W], _packed("user_id", "item_id", "w", "W"))
    q["user_vectors"] = q["table_dump"]
    q["similarity_rows"] = _with([*sim, _SS], _packed("item_1", "item_2", "val", "SS"))
    q["write_table_roundtrip"] = _with([_EV, _R], "SELECT user_id, item_id, rating FROM R")
    q["scaled_ratings"] = _with([_EV, _R, _W], "SELECT user_id, item_id, w FROM W")
    q["user_scores"] = _with([*sim, _SS, _W, _scores_cte()], "SELECT user_id, item_id, score FROM SC")
    q["top_k_per_user"] = f"""SELECT user_id, event_id, value, rank FROM (
  SELECT user_id, event_id, value,
         CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id ASC) AS INTEGER) AS rank
  FROM events) WHERE rank <= {C.EVENTS_K}"""
    q["recommend"] = _recommend_sql(C.RECOMMEND_K)
    q["recommend_bucketed"] = q["recommend"]
    q["recommend_symmetric"] = _recommend_sql(C.RECOMMEND_K, symmetric=True)
    q["recommend_unseen"] = _recommend_sql(C.RECOMMEND_K, unseen=True)
    q["recommend_padded"] = _padded_sql(C.PADDED_K)
    q["recommendation_text_padded"] = _padded_sql(C.PADDED_K, text=True)
    q["recommendation_text"] = _with(
        [*sim, _SS, _W, _scores_cte(), _top(C.RECOMMEND_K)],
        f"SELECT user_id, string_agg({_PACK.format(c='item_id', v='score')}, '' ORDER BY rank) AS recs "
        "FROM TOP GROUP BY user_id")
    q["item_similarity_frequent"] = q["item_similarity"].replace(
        f"n >= {C.MIN_SUPPORT}", f"n >= {C.FREQUENT_SUPPORT}")
    q["co_ratings_hot_users"] = q["co_ratings"]
    q["user_scores_shuffled"] = q["user_scores"]
    q["recommend_hot_users"] = q["recommend"]
    q["upsert_ratings_mixed"] = _with([_EV], f"""SELECT user_id, item_id, rating FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, item_id
                               ORDER BY l_orderkey % {C.UPSERT_MIXED_EVERY} = 0 DESC, {_RECENCY}) AS rn FROM EV)
WHERE rn = 1""")
    q["reject_bad_similarity"] = """SELECT s_suppkey || ' ' || s_suppkey || chr(9) || 'abc 20' AS line, 'non_numeric' AS reason
FROM supplier UNION ALL SELECT 'item ' || s_suppkey, 'short' FROM supplier"""
    q["reject_bad_items"] = """SELECT CAST(s_suppkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS genres,
  'short' AS reason FROM supplier UNION ALL SELECT 'item' || s_suppkey, 't', 'g', 'non_numeric' FROM supplier"""
    q["user_scores_packed"] = q["user_scores"]
    q["recommend_blocked"] = q["recommend_unseen"]
    q["ratings_of_item_clustered"] = q["ratings_of_item"]
    q["rating_lookup_clustered"] = _with([_EV, _R], """SELECT k.user_id, k.item_id, r.rating
FROM (SELECT CAST(n_nationkey + 1 AS BIGINT) AS user_id, CAST(n_regionkey + 1 AS BIGINT) AS item_id FROM nation) k
LEFT JOIN R r ON r.user_id = k.user_id AND r.item_id = k.item_id""")
    q["rating_lookup_many"] = _with([_EV, _R], f"""SELECT k.user_id, k.item_id, r.rating
FROM (SELECT o_custkey AS user_id, CAST(o_orderkey % {C.LOOKUP_ITEMS} + 1 AS BIGINT) AS item_id FROM orders) k
LEFT JOIN R r ON r.user_id = k.user_id AND r.item_id = k.item_id""")
    q["ratings_in_keys"] = _with([_EV, _R], f"""SELECT user_id, item_id, rating FROM R
WHERE user_id IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '{C.URGENT}')""")
    q["upsert_ratings_bucketed"] = q["upsert_ratings_mixed"]
    mixed = f"""R AS (
  SELECT user_id, item_id, rating FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, item_id
                                 ORDER BY l_orderkey % {C.UPSERT_MIXED_EVERY} = 0 DESC, {{order}}) AS rn FROM EV) WHERE rn = 1)"""
    merged = mixed.format(order=_RECENCY)
    q["pair_stats_incremental"] = _with([_EV, merged, _co(), _PS], "SELECT item_1, item_2, n, num, d1, d2 FROM PS")
    q["item_similarity_incremental"] = _with([_EV, merged, _co(), _PS, _S], "SELECT item_1, item_2, similarity, n_ratings FROM S")
    entry = _PACK.format(c=f"item_2 * {C.WIDE}", v="val")
    q["packed_text_wide"] = _with([*sim, _SS], f"""SELECT item_1 * {C.WIDE} AS item_1, string_agg({entry}, '' ORDER BY item_2) AS packed
FROM SS GROUP BY item_1""")
    q["split_log"] = _with([_EV, _R], f"""SELECT user_id, item_id, rating, CAST(NULL AS VARCHAR) AS line, CAST(NULL AS VARCHAR) AS reason FROM R
UNION ALL SELECT NULL, NULL, NULL, line, reason FROM ({q["reject_bad_ratings"][q["reject_bad_ratings"].rindex("SELECT '" + C.RATING_HEADER):]}) x""")
    by_time = "l_shipdate DESC, rating DESC"
    newest = f"""R AS (
  SELECT user_id, item_id, rating FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, item_id ORDER BY {by_time}) AS rn FROM EV) WHERE rn = 1)"""
    q["item_similarity_raw_log"] = _with([_EV, newest, _co(), _PS, _S], "SELECT item_1, item_2, similarity, n_ratings FROM S")
    q["stream_ingest_raw_log"] = _with([_EV, mixed.format(order=by_time)], "SELECT user_id, item_id, rating FROM R")
    q["load_job"] = q["stream_ingest_raw_log"]
    q["run_stamped_paths"] = _with([_EV, _R], "SELECT user_id, item_id, rating, rating >= 3 AS second_run FROM R")
    q["similarity_text_order"] = _with([*sim, "K AS (SELECT item_1 || ' ' || item_2 AS k FROM S)"],
                                       "SELECT COUNT(*) AS n_lines, CAST(0 AS BIGINT) AS lines_out_of_order, CAST(0 AS BIGINT) AS files_out_of_order, "
                                       "MIN(k) AS first_key, MAX(k) AS last_key FROM K")
    return q
