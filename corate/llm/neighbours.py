"""Approximate nearest neighbours by collision counting on single projections.

Each of ``PROJECTIONS`` random directions gives a sorted array of projections. A query opens a window
around its own projection in every array and widens all of them together, by a ladder of widths (virtual
rehashing); a vector that lies in ``THRESHOLD`` of the windows is verified by its exact inner product. The
width of a query is the first of the ladder at which ``SHARE`` of a fixed sample of the vectors is reached (more
where that would be fewer than ``LEAST`` vectors), so it does not depend on how the vectors are dealt into blocks; a block that finds fewer than ``k`` widens further.

Largest inner products become nearest neighbours by one more coordinate, ``sqrt(M^2 - |x|^2)`` with
the largest length ``M``, which is 0 for the query. Vectors are dealt into blocks and queries into
chunks; each pair of block and chunk is a group of bounded size, and the best of all blocks are merged.
In a block a window is an interval of ranks, found by binary search for all queries of a chunk; the
collisions of all its vectors are counted by comparing their ranks with the intervals.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corate.llm.common import table, write_stage

PROJECTIONS = 96
THRESHOLD = 77        # of the windows
SHARE, LEAST = 0.2, 600   # of the vectors are verified per query, and so many at least
SAMPLE = 1024         # vectors that the widths are fitted on, those with the smallest hash of their id
BLOCK, CHUNK = 16_384, 2_048   # ranks of a block take 16 bits
TILE = 4_096          # vectors compared at a time
K = 20
GROWTH = 1.05         # steps of the ladder


def _directions(dim: int) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim + 1, PROJECTIONS))


def _projected(x: np.ndarray, longest: float) -> np.ndarray:
    a = _directions(x.shape[1])
    return x @ a[:-1] + np.sqrt(np.maximum(longest ** 2 - (x * x).sum(1), 0))[:, None] * a[-1]


def _asked(q: np.ndarray, longest: float) -> np.ndarray:
    return q / np.linalg.norm(q, axis=1, keepdims=True) * longest @ _directions(q.shape[1])[:-1]


def _widths(sample: np.ndarray, pq: np.ndarray, share: float) -> np.ndarray:
    """Per query the first width of the ladder at which ``share`` of the sample's vectors collide often enough."""
    at = min(len(sample) - 1, int(share * len(sample)))
    out = np.empty(len(pq))
    for i, row in enumerate(pq):
        reached = np.partition(np.abs(sample - row), THRESHOLD - 1, axis=1)[:, THRESHOLD - 1]
        out[i] = np.partition(reached, at)[at]
    return GROWTH ** np.ceil(np.log(np.maximum(out, 1e-300)) / np.log(GROWTH))


def _ranked(px: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted arrays, and each vector's rank in each: [projections, n]."""
    order = np.argsort(px, axis=0, kind="stable")
    ranks = np.empty(px.shape, np.uint16)
    np.put_along_axis(ranks, order, np.arange(len(px), dtype=np.uint16)[:, None], axis=0)
    return np.take_along_axis(px, order, axis=0), np.ascontiguousarray(ranks.T)


def _windows(line: np.ndarray, pq: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First rank and length of every query's window in every array: [queries, projections]."""
    lo = np.stack([np.searchsorted(line[:, p], pq[:, p] - width) for p in range(PROJECTIONS)], axis=1)
    hi = np.stack([np.searchsorted(line[:, p], pq[:, p] + width, side="right") for p in range(PROJECTIONS)], axis=1)
    return lo, hi - lo


def _collided(ranks: np.ndarray, lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The vectors that lie in THRESHOLD windows or more."""
    found, lo, size = [], lo.astype(np.uint16)[:, None], size.astype(np.uint16)[:, None]
    for start in range(0, ranks.shape[1], TILE):
        inside = (ranks[:, start: start + TILE] - lo) < size   # unsigned: ranks below the window wrap around
        found.append(start + np.flatnonzero(inside.view(np.uint8).sum(axis=0, dtype=np.uint8) >= THRESHOLD))
    return np.concatenate(found)


def _search(k: int, longest: float):
    def search(key, data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if len(data) == 0 or len(queries) == 0:
            return none
        data = data.sort_values("vec_id", kind="stable")
        ids = data["vec_id"].to_numpy()
        x = np.stack(data["embedding"].to_numpy()).astype(np.float64)
        q = np.stack(queries["embedding"].to_numpy()).astype(np.float64)
        out = []
        for first in range(0, len(x), 1 << 15):   # a block is dealt by hash and may be somewhat larger than BLOCK
            rows, names = x[first: first + (1 << 15)], ids[first: first + (1 << 15)]
            line, ranks = _ranked(_projected(rows, longest))
            pq, width = _asked(q, longest), queries["width"].to_numpy(np.float64).copy()
            lo, size = _windows(line, pq, width)
            for i, qid in enumerate(queries["vec_id"].to_numpy()):
                found = _collided(ranks, lo[i], size[i])
                while (names[found] != qid).sum() < min(k, (names != qid).sum()):
                    width[i] *= GROWTH ** 4
                    one = _windows(line, pq[i: i + 1], width[i: i + 1])
                    found = _collided(ranks, one[0][0], one[1][0])
                found = found[names[found] != qid]
                score = (rows[found] * q[i]).sum(1)
                if len(score) > k:
                    near = score >= np.partition(score, len(score) - k)[len(score) - k]
                    found, score = found[near], score[near]
                best = np.lexsort((names[found], -score))[:k]
                out.append(pd.DataFrame({"query_id": qid, "vec_id": names[found][best], "score": score[best]}))
        return pd.concat(out) if out else none
    return search


def nearest(vectors: DataFrame, queries: DataFrame, *, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row of ``queries`` its ``k`` best rows of
    ``vectors`` by inner product (double precision), ties to the smaller id, without rows of its own id.

    Vectors that are null or zero or hold a null or non-finite component take no part, nor do ids that
    are null; vectors are compared with those of the same dimension. An id listed several times
    with one vector counts once, with different vectors once for each. Empty tables give no rows.
    Other columns are ignored."""
    def usable(df: DataFrame) -> DataFrame:
        v = F.transform(F.col(vec_col), lambda c: c.cast("double"))
        df = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("embedding")).filter(
            F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
            & ~F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
            & F.exists("embedding", lambda c: c != 0))
        return df.dropDuplicates().withColumn("_dim", F.size("embedding"))
    data, asked = write_stage(usable(vectors), "ann-data"), write_stage(usable(queries), "ann-queries")
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, c: s + c * c))
    dims = data.groupBy("_dim").agg(F.count("*").alias("n"), F.max(length).alias("m"))
    size = dims.agg(F.sum("n").alias("n"), F.max("m").alias("m"), F.max_by("_dim", "n").alias("dim")).first()
    longest, n = float(size["m"] or 0.0), int(size["n"] or 0)
    share = max(SHARE, LEAST / max(n, 1))
    # The sample is of the most frequent dimension; queries of another begin with the narrowest windows.
    chosen = data.filter(F.col("_dim") == F.lit(size["dim"])).orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(SAMPLE)
    sample = np.array([r["embedding"] for r in chosen.select("embedding").collect()], np.float64)   # SAMPLE vectors at most
    sample = vectors.sparkSession.sparkContext.broadcast(_projected(sample, longest) if len(sample) else sample)

    def fitted(batches):
        for pdf in batches:
            for dim, part in pdf.groupby("_dim"):
                q = np.stack(part["embedding"].to_numpy()).astype(np.float64)
                same = len(sample.value) and dim == size["dim"]
                yield part.assign(width=_widths(sample.value, _asked(q, longest), share) if same else 1e-9 * longest)

    asked = write_stage(asked.mapInPandas(fitted, "vec_id long, embedding array<double>, _dim int, width double"), "ann-widths")
    blocks, chunks = max(1, -(-n // BLOCK)), max(1, -(-asked.count() // CHUNK))
    data = data.withColumn("_b", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn(
        "_c", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    asked = asked.withColumn("_c", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(chunks)).cast("int")).withColumn(
        "_b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    cell = ["_dim", "_b", "_c"]
    near = data.groupBy(*cell).cogroup(asked.groupBy(*cell)).applyInPandas(
        _search(k, longest), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def q_op8(spark, sf_dir):
    """The 20 nearest of every twentieth vector."""
    e = table(spark, sf_dir, "embeddings")
    return nearest(e, e.filter(F.col("vec_id") % 20 == 0))
