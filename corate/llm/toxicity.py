"""Toxicity by a classifier chain of linear models.

The labels are predicted in order; a later model also sees the probabilities of the earlier ones.
For its training these are out of fold: each row's come from a model that has not seen the row, as
is the case for the documents to be scored. Features are the words of a document and their first
letters, hashed; each is scaled by its log-odds between the classes, and a logistic regression is
fitted on the scaled features. All documents are scored whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.llm.common import free_name, shielded, table, text_or_empty, write_stage

CHAIN = ("quality", "toxic")
MAX_TRAIN = 20_000    # labelled rows to learn from: the first in the order of a hash of the id
FOLDS = 3
DIMENSIONS = 1 << 18
PREFIX = 4
THRESHOLD = 0.5
STEPS, RATE, RIDGE, MIN_COUNT = 80, 0.1, 1e-4, 5


def _features(text_col: str) -> Column:
    w = F.array_distinct(F.regexp_extract_all(F.lower(text_or_empty(text_col)), F.lit(r"\p{L}+"), F.lit(0)))
    both = F.flatten(F.transform(w, lambda x: F.array(x, F.concat(F.lit("^"), F.substring(x, 1, PREFIX)))))
    return F.array_distinct(F.transform(both, lambda x: F.pmod(F.xxhash64(x), F.lit(DIMENSIONS)).cast("int")))


def _sums(weights: np.ndarray, lists) -> np.ndarray:
    """Sum of the weights at each list of positions."""
    size = np.array([len(x) for x in lists], dtype=np.int64)
    out = np.zeros(len(size))
    if size.sum():
        flat = np.concatenate([np.asarray(x, dtype=np.int64) for x in lists if len(x)])
        has = size > 0
        out[has] = np.add.reduceat(weights[flat], np.concatenate(([0], np.cumsum(size[has])[:-1])))
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit_logistic(lists, y: np.ndarray, extra: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of the hashed features, of the ``extra`` columns, and the constant. Labels of a single
    class (or none) give that class (or 0) as a constant."""
    k = extra.shape[1]
    if len(y) == 0 or y.min() == y.max():
        return np.zeros(DIMENSIONS), np.zeros(k), 50.0 if len(y) and y[0] > 0 else -50.0
    size = np.array([len(x) for x in lists], dtype=np.int64)
    at = np.concatenate([np.asarray(x, dtype=np.int32) for x in lists]).astype(np.int64)
    has = size > 0
    start = np.concatenate(([0], np.cumsum(size[has])[:-1])).astype(np.int64)
    pos = np.bincount(at, np.repeat(y, size), DIMENSIONS) + 1
    neg = np.bincount(at, np.repeat(1 - y, size), DIMENSIONS) + 1
    scale = np.log(pos / pos.sum()) - np.log(neg / neg.sum())
    scale[pos + neg - 2 < MIN_COUNT] = 0
    scale /= max(np.abs(scale).max(), 1e-9)
    used = np.flatnonzero(pos + neg > 2)
    place = np.zeros(DIMENSIONS, np.int64)
    place[used] = np.arange(len(used))
    np.take(place, at, out=at, mode="clip")
    s, d = scale[used], len(used)
    theta, m, v = np.zeros(d + k + 1), np.zeros(d + k + 1), np.zeros(d + k + 1)
    for step in range(1, STEPS + 1):  # Adam on the whole sample
        z = extra @ theta[d: d + k] + theta[-1]
        if len(at):
            z[has] += np.add.reduceat((s * theta[:d])[at], start)
        g = (_sigmoid(z) - y) / len(y)
        grad = np.concatenate((s * np.bincount(at, np.repeat(g, size), d) + RIDGE * theta[:d], extra.T @ g + RIDGE * theta[d: d + k], [g.sum()]))
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    weights = np.zeros(DIMENSIONS)
    weights[used] = theta[:d] * s
    return weights, theta[d: d + k], float(theta[-1])


def _trainer(label: str, before: list[str]):
    """One model per job: job f < FOLDS leaves fold f out and scores it; job FOLDS learns from all."""
    def run(key, pdf):
        job = int(key[0])
        pdf = pdf.sort_values("_row", kind="stable")
        known = pdf[label].notna().to_numpy()
        out = (pdf["_fold"] == job).to_numpy()
        extra = pdf[before].to_numpy(dtype=float).reshape(len(pdf), len(before))
        use = np.flatnonzero(known & ~out)
        lists = pdf["_f"].tolist()
        w, v, b = fit_logistic([lists[i] for i in use], pdf[label].to_numpy(dtype=float)[use], extra[use])
        if job == FOLDS:
            return pd.DataFrame({"job": [job], "row": [None], "p": [None], "w": [w.tobytes()], "v": [v.tolist()], "b": [b]})
        at = np.flatnonzero(out)
        p = _sigmoid(_sums(w, [lists[i] for i in at]) + extra[at] @ v + b)
        return pd.DataFrame({"job": job, "row": pdf["_row"].to_numpy()[at], "p": p, "w": None, "v": None, "b": None})
    return run


def fit_chain(docs: DataFrame, labels: DataFrame, *, chain: tuple[str, ...] = CHAIN, id_col: str = "doc_id",
              text_col: str = "text", max_train: int = MAX_TRAIN) -> list[tuple]:
    """The chain's models ``(weights, weights of earlier probabilities, constant)``. At most
    ``max_train`` labelled documents are used; ids labelled twice count once (the larger label), labels
    without a document and null labels not at all. A model is fitted in one task, from these rows."""
    first = labels.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(*[F.max(c).alias(c) for c in chain])
    chosen = first.orderBy(F.xxhash64(id_col), id_col).limit(max_train)
    train = docs.select(id_col, _features(text_col).alias("_f")).join(F.broadcast(chosen), id_col)  # max_train rows
    train = train.select(F.xxhash64(id_col, "_f").alias("_row"), "_f", *[F.col(c).cast("double").alias(c) for c in chain])
    train = write_stage(train.dropDuplicates(["_row"]).withColumn("_fold", F.pmod(F.xxhash64("_row"), F.lit(FOLDS)).cast("int")), "tox-train")
    models = []
    for i, label in enumerate(chain):
        before = [f"_p_{x}" for x in chain[:i]]
        jobs = [FOLDS] if i + 1 == len(chain) else list(range(FOLDS + 1))
        each = train.withColumn("_job", F.explode(F.array(*map(F.lit, jobs)))).select("_job", "_row", "_fold", "_f", label, *before)
        fitted = each.groupBy("_job").applyInPandas(_trainer(label, before), "job int, row long, p double, w binary, v array<double>, b double")
        fitted = write_stage(fitted, "tox-fit")
        got = fitted.filter(F.col("job") == FOLDS).first()
        if got is None:  # no labelled documents
            models.append((np.zeros(DIMENSIONS), np.zeros(i), -50.0))
        else:
            models.append((np.frombuffer(got["w"]).copy(), np.array(got["v"], dtype=float), got["b"]))
        if i + 1 < len(chain):
            p = fitted.filter("row is not null").select(F.col("row").alias("_row"), F.col("p").alias(f"_p_{label}"))
            train = write_stage(train.join(p, "_row"), "tox-fold")
    return models


def score(docs: DataFrame, labels: DataFrame, *, chain: tuple[str, ...] = CHAIN, id_col: str = "doc_id",
          text_col: str = "text", max_train: int = MAX_TRAIN) -> DataFrame:
    """Every row of ``docs`` with ``p_<label>`` for the labels of the chain.

    Null and empty texts have no words and get the models' constants. Without usable labels every
    probability is about 0, with labels of one class only it is that class's. Columns named
    ``p_<label>`` are replaced; other columns pass through; rows listed twice are scored twice."""
    names = [c for c in docs.columns if c not in {f"p_{x}" for x in chain}]
    models = docs.sparkSession.sparkContext.broadcast(
        fit_chain(docs, labels, chain=chain, id_col=id_col, text_col=text_col, max_train=max_train))

    def chained(lists: pd.Series) -> pd.DataFrame:
        lists, done = lists.tolist(), []
        for w, v, b in models.value:
            done.append(_sigmoid(_sums(w, lists) + sum((c * p for c, p in zip(v, done, strict=True)), np.zeros(len(lists))) + b))
        return pd.DataFrame({f"p_{x}": p for x, p in zip(chain, done, strict=True)})

    udf = F.pandas_udf(chained, ", ".join(f"p_{x} double" for x in chain))
    out = docs.select(*names, udf(_features(text_col)).alias("_p"))
    return out.select(*names, *[F.col(f"_p.p_{x}").alias(f"p_{x}") for x in chain])


def reject_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, chain: tuple[str, ...] = CHAIN,
                 **kw) -> DataFrame:
    """``docs`` without those whose last label of the chain has a probability of ``threshold`` or
    more; all columns stay, also such as are named like a probability."""
    names = docs.columns
    docs, restored = shielded(docs, kw.get("id_col", "doc_id"), kw.get("text_col", "text"))
    held = {c: free_name(docs, f"held_{c}") for c in docs.columns if c.startswith("p_")}
    s = score(docs.withColumnsRenamed(held), labels, chain=chain, **kw).filter(F.col(f"p_{chain[-1]}") < threshold)
    return restored(s.drop(*[f"p_{x}" for x in chain]).withColumnsRenamed({v: k for k, v in held.items()})).select(*names)


def q_op9(spark, sf_dir):
    """Probabilities of all labels, and the verdict, for all documents."""
    s = score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return s.select("doc_id", "p_quality", "p_toxic", (F.col("p_toxic") >= THRESHOLD).alias("toxic"))
