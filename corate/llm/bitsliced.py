"""Exact top-k by inner product over a bit-sliced index.

Components are quantised to integers, ``floor(SCALE * x)``. The index of a block of vectors holds, for each
dimension, one bitmap over the block's vectors per binary digit of the component's upper part (all but the
lowest ``DROP`` digits, counted from the block's smallest). A query multiplies and adds these slices with
bitmap arithmetic: every set digit of its own component adds the slices at another place, a negative
component takes the complement, and carry-save adders reduce all bitmaps of a place at once to one. The sum's
slices give a lower bound of every score and a width that holds for all of them.

The k-th largest sum is read from the most significant slice downward, and so are the rows whose sum lies
within the width of it: no other row can be among the k best. These boundary rows get their exact score
from the whole integers, and ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corate.llm.common import table, write_stage

SCALE = 256
K = 5
DROP = 3                     # lowest digits of a component that are left to the exact check
BLOCK, CHUNK = 8_192, 2_048  # vectors in a block, queries in a chunk
LARGEST = 1 << 31            # components beyond are held at this value
_INDEX = "_dim int, _block int, n int, ids binary, whole binary, low binary, digits int, slices binary"


def _digits(values: np.ndarray, n: int) -> np.ndarray:
    """Bitmaps [dim, n, words] of the ``n`` lowest binary digits of ``values`` [rows, dim]."""
    rows, dim = values.shape
    words = -(-max(rows, 1) // 64)
    bits = np.zeros((dim, n, words * 64), np.uint8)
    for i in range(n):
        bits[:, i, :rows] = ((values >> i) & 1).T
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


def build(pdf: pd.DataFrame) -> pd.DataFrame:
    """The index of one block as one row."""
    pdf = pdf.sort_values("vec_id", kind="stable")
    ids = pdf["vec_id"].to_numpy(np.int64)
    whole = np.stack([np.asarray(v, np.int64) for v in pdf["whole"]]).reshape(len(pdf), -1)
    upper = whole >> DROP
    low = upper.min(0) if whole.size else np.zeros(whole.shape[1], np.int64)
    digits = int((upper - low).max()).bit_length() if whole.size else 0
    return pd.DataFrame({"_dim": [whole.shape[1]], "_block": [int(pdf["_block"].iloc[0])], "n": [len(pdf)], "ids": [ids.tobytes()], "whole": [whole.tobytes()],
                         "low": [low.astype(np.int64).tobytes()], "digits": [digits], "slices": [_digits(upper - low, digits).tobytes()]})


def _added(places: dict[int, list[np.ndarray]], words: int) -> list[np.ndarray]:
    """The binary digits of the sum of bitmaps at places (powers of two): three of a place become one there
    and one at the next, until each place has one."""
    out, place = [], 0
    while places:
        have = places.pop(place, [])
        m = np.concatenate(have) if have else np.zeros((1, words), np.uint64)
        while len(m) > 1:
            if len(m) == 2:
                places.setdefault(place + 1, []).append(m[:1] & m[1:])
                m = m[:1] ^ m[1:]
                break
            third = len(m) // 3
            a, b, c = m[:third], m[third: 2 * third], m[2 * third: 3 * third]
            half = a ^ b
            places.setdefault(place + 1, []).append((a & b) | (c & half))
            m = np.concatenate([half ^ c, m[3 * third:]])
        out.append(m[0])
        place += 1
    return out


def _kth(total: list[np.ndarray], among: np.ndarray, k: int) -> int:
    """The k-th largest sum of the rows ``among``, from the most significant slice downward."""
    sure, open_, value = np.zeros_like(among), among, 0
    for place in range(len(total) - 1, -1, -1):
        ones = open_ & total[place]
        if int(np.bitwise_count(sure | ones).sum()) >= k:
            open_, value = ones, value | 1 << place
        else:
            sure, open_ = sure | ones, open_ & ~total[place]
    return value


def _at_least(total: list[np.ndarray], among: np.ndarray, value: int) -> np.ndarray:
    if value <= 0:
        return among
    if value >> len(total):
        return np.zeros_like(among)
    above, equal = np.zeros_like(among), among
    for place in range(len(total) - 1, -1, -1):
        if value >> place & 1:
            equal = equal & total[place]
        else:
            above, equal = above | equal & total[place], equal & ~total[place]
    return above | equal


def search_block(row, q_ids: np.ndarray, q: np.ndarray, k: int):
    """``(query_id, vec_id, score)`` of the k best of an index row for each query [queries, dim]."""
    n, dim, digits = row["n"], row["_dim"], row["digits"]
    ids = np.frombuffer(row["ids"], np.int64)
    whole = np.frombuffer(row["whole"], np.int64).reshape(n, dim)
    words = -(-n // 64)
    plain = np.frombuffer(row["slices"], np.uint64).reshape(dim, digits, words)
    inverse = ~plain
    valid = np.packbits(np.arange(words * 64) < n, bitorder="little").view(np.uint64)
    safe = dim * float(np.abs(whole).max(initial=0)) * float(np.abs(q).max(initial=0)) < 2.0 ** 62
    out = []
    for qid, v in zip(q_ids.tolist(), q, strict=True):
        among = valid.copy()
        own = np.arange(np.searchsorted(ids, qid), np.searchsorted(ids, qid, side="right"))
        np.bitwise_and.at(among, own // 64, ~(np.uint64(1) << (own % 64).astype(np.uint64)))
        left = n - len(own)
        if not left:
            continue
        if left > k and digits:
            size = np.abs(v)
            places: dict[int, list[np.ndarray]] = {}
            for side, of in ((plain, v > 0), (inverse, v < 0)):
                for bit in range(int(size.max()).bit_length()):
                    on = np.flatnonzero(of & (size >> bit & 1 == 1))
                    for i in range(digits if len(on) else 0):
                        places.setdefault(bit + i, []).append(side[on, i])
            total = _added(places, words)
            # A sum stands for scores up to this much apart, in units of a sum's last digit.
            width = ((1 << DROP) - 1) * int(size.sum()) >> DROP
            among = _at_least(total, among, _kth(total, among, k) - width)
        rows = np.flatnonzero(np.unpackbits(among.view(np.uint8), bitorder="little", count=n))
        score = whole[rows] @ v if safe else (whole[rows].astype(object) * v.astype(object)).sum(1)
        best = sorted(range(len(rows)), key=lambda i: (-score[i], ids[rows[i]]))[:k] if len(rows) <= 256 or not safe else np.lexsort((ids[rows], -score))[:k]
        out += [(qid, int(ids[rows[i]]), max(-(1 << 63), min((1 << 63) - 1, int(score[i])))) for i in best]
    return out


def _search(k: int):
    def search(index: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if index.num_rows and asked.num_rows:
            q = np.stack([np.asarray(x, np.int64) for x in asked.column("whole").to_pylist()]).reshape(asked.num_rows, -1)
            for row in index.to_pylist():
                out += search_block(row, asked.column("vec_id").to_numpy(), q, k)
        return pa.table({c: pa.array([r[i] for r in out], pa.int64()) for i, c in enumerate(("query_id", "vec_id", "score"))})
    return search


def quantised(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(vec_id, whole, _dim)``: the usable vectors as integers."""
    v = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    d = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("_v")).filter(
        F.col("vec_id").isNotNull() & F.col("_v").isNotNull() & ~F.exists("_v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    whole = F.transform("_v", lambda c: F.floor(F.greatest(F.lit(float(-LARGEST)), F.least(F.lit(float(LARGEST)), c * float(scale)))).cast("long"))
    return d.select("vec_id", whole.alias("whole")).withColumn("_dim", F.size("whole"))


def build_index(data: DataFrame, block: int = BLOCK) -> DataFrame:
    """The written index of ``quantised`` vectors with a number ``_row`` each: one row per block of about ``block``
    vectors of one dimension. A vector listed many times is dealt to all blocks."""
    blocks = max(1, -(-data.count() // block))
    dealt = data.withColumn("_block", F.pmod(F.xxhash64("vec_id", "_row"), F.lit(blocks)).cast("int"))
    return write_stage(dealt.groupBy("_dim", "_block").applyInPandas(build, _INDEX), "bitsliced-index")


def top_k(vectors: DataFrame, queries: DataFrame, *, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``queries`` its ``k`` best rows of ``vectors`` (all, if
    fewer) by the inner product of the quantised vectors, ties to the smaller id, without rows of its own id.

    Vectors that are null or hold a null or non-finite component take no part, nor do null ids; a zero vector
    does. Components are held at 2^31 and scores at the ends of long. Vectors are compared with those of their
    dimension. Each row is a candidate, also where an id or a vector is listed again; an id asks once with each of
    its different vectors, and its ranks run over what all of them find. Empty tables give no rows; other columns are ignored."""
    data = write_stage(quantised(vectors, id_col=id_col, vec_col=vec_col, scale=scale).withColumn("_row", F.monotonically_increasing_id()), "bitsliced-data")
    asked = write_stage(quantised(queries, id_col=id_col, vec_col=vec_col, scale=scale).dropDuplicates(), "bitsliced-queries")
    index = build_index(data)
    chunks = max(1, -(-asked.count() // CHUNK))
    # Every block meets every chunk of queries in one group: an index row and at most about CHUNK queries.
    index = index.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    places = F.broadcast(index.select(F.col("_dim").alias("_d"), F.col("_block").alias("_b")).distinct())  # a few bytes per block of vectors
    dealt = asked.withColumn("_chunk", F.pmod(F.xxhash64("vec_id", "whole"), F.lit(chunks)).cast("int"))
    dealt = dealt.join(places, F.col("_dim") == F.col("_d")).select("_dim", F.col("_b").alias("_block"), "_chunk", "vec_id", "whole")
    cell = ["_dim", "_block", "_chunk"]
    found = index.groupBy(*cell).cogroup(dealt.groupBy(*cell)).applyInArrow(_search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def q_op13(spark, sf_dir):
    """The 5 best of every fiftieth vector."""
    e = table(spark, sf_dir, "embeddings")
    return top_k(e, e.filter(F.col("vec_id") % 50 == 0))


SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM (SELECT DISTINCT * FROM v) a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {K}"""
