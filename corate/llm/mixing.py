"""Mixing sources to target weights by weighted fair queueing (DataFrame operations only).

Every source is a queue of its documents in a fixed pseudo-random order. A document that ends at
word ``c`` of its queue has the virtual finish time ``c / target(source)``; a queue that must give
more words than it has starts over (epochs, at most ``cap`` of them). Serving documents by
ascending finish time until the total budget is used gives every source its target share, to
within one document.

The cumulative sums need no group of a whole source: a source is cut into ``BUCKETS`` ranges of
the shuffle key, the ranges' totals are summed up first, and rows are only ordered inside their
range. Likewise the global order by finish time is never sorted in one place: a histogram of
finish times finds the range that holds the end of the budget, and only that range is sorted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corate.llm.common import shielded, table, text_or_empty, words, write_stage

WEIGHTS = (5, 2, 1)
CAP = 3
BUCKETS = 4096   # ranges of the shuffle key per source
BINS = 4096      # ranges of finish times, refined once


@dataclass
class Plan:
    """``grid``: per (source, range) the words before it, the source's size and target;
    ``cut``: (finish, source is null, source, key) of the last document served, or None if all are."""

    grid: DataFrame
    cut: tuple | None


def _prepared(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Adds the size in words, the shuffle key and its range. The key depends on id and text alone:
    rows with equal keys are the same document listed twice, and interchangeable."""
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text_or_empty(text_col)))
    d = (docs.withColumn("_size", F.size(words(text_col)).cast("long")).withColumn("_key", key)
         .withColumn("_src", F.col(source_col).cast("string")))
    return d.withColumn("_bucket", F.conv(F.substring("_key", 1, 3), 16, 10).cast("int")).withColumn(
        "_sid", F.when(F.col("_src").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("_src"))))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.0, cap: int = CAP) -> DataFrame:
    """``(_sid, _src, _source_size, _target)`` from rows ``(_sid, _src, _size)``.

    Sources by code point, null last, take ``weights`` in turn and share ``share`` of all words. No
    target exceeds ``cap`` times its source; the excess goes to the others by weight. That is a
    water level: with sources ordered by cap / weight, the first k are full, and the level of the
    others is (budget - caps of the first k) / (their weights)."""
    s = sizes.groupBy("_sid", "_src").agg(F.sum("_size").alias("_source_size"))
    order = F.col("_src").asc_nulls_last()
    turn = (F.row_number().over(Window.orderBy(order)) - 1) % len(weights) + 1
    s = s.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn))
    s = s.withColumn("_cap", F.col("_source_size") * F.lit(cap))
    every = Window.partitionBy()
    by = Window.orderBy((F.col("_cap") / F.col("_w")).asc(), order)
    full = F.coalesce(F.sum("_cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("_w").over(by.rowsBetween(0, Window.unboundedFollowing))
    budget = F.sum("_source_size").over(every) * F.lit(float(share))
    s = s.withColumn("_level", (budget - full) / left)
    level = F.max(F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level"))).over(every)
    target = F.when(level.isNull(), F.col("_cap").cast("double")).otherwise(
        F.least(F.col("_cap").cast("double"), level * F.col("_w")))
    return s.select("_sid", "_src", "_source_size", target.alias("_target"))


def _queued(d: DataFrame, grid: DataFrame) -> DataFrame:
    """Adds ``_cum``: the words of the queue up to and with this document."""
    w = Window.partitionBy("_sid", "_bucket").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    j = d.withColumn("_in", F.sum("_size").over(w)).join(grid, ["_sid", "_bucket"], "left")
    return j.withColumn("_cum", F.col("_in") + F.col("_before")).drop("_in", "_before")


def _finish(epoch: Column) -> Column:
    return (epoch * F.col("_source_size") + F.col("_cum")).cast("double") / F.col("_target")


def _cut(copies: DataFrame, total: int) -> tuple | None:
    """The last copy whose running total of sizes, by finish time, is within ``total``. Two jobs
    over histograms of finish times narrow the range; only the last range is sorted."""
    rest, before, lo, width = copies, 0, 0.0, float(CAP + 1)
    for _ in range(2):
        step = width / BINS
        at = F.floor((F.col("_finish") - F.lit(lo)) / F.lit(step))
        bins = rest.groupBy(at.alias("_bin")).agg(F.sum("_size").alias("_words"))
        run = F.sum("_words").over(Window.orderBy("_bin"))
        full = bins.withColumn("_run", run + F.lit(before)).filter(F.col("_run") > total).orderBy("_bin").first()
        if full is None:
            return None
        before = full["_run"] - full["_words"]
        rest = rest.filter(at == F.lit(full["_bin"]))
        lo, width = lo + step * full["_bin"], step
    order = [F.col("_finish").asc(), F.col("_src").asc_nulls_last(), F.col("_key").asc()]
    run = F.sum("_size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    last = (rest.withColumn("_run", run + F.lit(before)).filter(F.col("_run") <= total)
            .orderBy(F.col("_run").desc()).first())
    # Nothing of this range fits: the cut lies just before it.
    return (last["_finish"], last["_src"], last["_key"]) if last else (lo, None, "")


def plan(docs: DataFrame, *, weights=WEIGHTS, share: float = 1.0, cap: int = CAP, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source") -> Plan:
    """Targets, queue offsets and the cut, from one pass over the texts."""
    d = write_stage(_prepared(docs, id_col, text_col, source_col).select("_sid", "_src", "_bucket", "_key", "_size"),
                    "mix-sizes")
    targets = source_targets(d, weights, share, cap)
    ranges = d.groupBy("_sid", "_bucket").agg(F.sum("_size").alias("_words"))
    up = Window.partitionBy("_sid").orderBy("_bucket")
    ranges = ranges.select("_sid", "_bucket", (F.sum("_words").over(up) - F.col("_words")).alias("_before"))
    grid = write_stage(ranges.join(targets.drop("_src"), "_sid"), "mix-grid")
    total = d.agg(F.floor(F.sum("_size") * F.lit(float(share))).cast("long").alias("t")).first()["t"] or 0
    q = _queued(d.filter(F.col("_size") > 0), grid).filter(F.col("_target") > 0)
    copies = q.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.lit(cap - 1)))).withColumn(
        "_finish", _finish(F.col("_epoch")))
    return Plan(grid, _cut(copies.select("_finish", "_src", "_key", "_size"), total))


def _served(cut: tuple | None, finish: Column) -> Column:
    if cut is None:
        return F.lit(True)
    at, src, key = cut
    if src is None:
        tie = (F.col("_src").isNotNull() | (F.col("_key") <= F.lit(key))) if key else F.lit(False)
    else:
        tie = (F.col("_src") < F.lit(src)) | ((F.col("_src") == F.lit(src)) & (F.col("_key") <= F.lit(key)))
    return (finish < F.lit(at)) | ((finish == F.lit(at)) & F.coalesce(tie, F.lit(False)))


def schedule(docs: DataFrame, *, weights=WEIGHTS, share: float = 1.0, cap: int = CAP, id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Every row of ``docs`` with ``mix_size`` (words), ``mix_source_size``, ``mix_target`` and
    ``mix_copies``, the number of times that the mix takes it (0 to ``cap``).

    Null and empty texts have size 0 and are never taken; a null source is a source of its own; rows
    listed twice queue twice; other columns pass through (columns with the ``mix_`` names above are
    replaced). No rows: no rows."""
    docs, restored = shielded(docs, id_col, text_col, source_col)
    return restored(_scheduled(docs, weights, share, cap, id_col, text_col, source_col).drop("_cum"))


def _scheduled(docs: DataFrame, weights, share: float, cap: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``schedule`` with the words before and in the document as ``_cum``."""
    names = [c for c in docs.columns if c not in ("mix_size", "mix_source_size", "mix_target", "mix_copies")]
    p = plan(docs, weights=weights, share=share, cap=cap, id_col=id_col, text_col=text_col, source_col=source_col)
    q = _queued(_prepared(docs.select(*names), id_col, text_col, source_col), p.grid)
    copies = sum((F.when((F.col("_size") > 0) & (F.col("_target") > 0) & _served(p.cut, _finish(F.lit(e))), 1)
                  .otherwise(0) for e in range(cap)), F.lit(0))
    return q.select(*names, F.col("_size").alias("mix_size"), F.col("_source_size").alias("mix_source_size"),
                    F.col("_target").alias("mix_target"), copies.cast("int").alias("mix_copies"),
                    F.col("_cum").alias("_cum"))


def mix(docs: DataFrame, *, weights=WEIGHTS, share: float = 1.0, cap: int = CAP, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: one row per document taken and epoch, with ``mix_epoch`` and ``mix_finish``,
    range-sorted by virtual finish time (reading the files in order interleaves the sources)."""
    docs, restored = shielded(docs, id_col, text_col, source_col)
    s = _scheduled(docs, weights, share, cap, id_col, text_col, source_col)
    names = [c for c in s.columns if not c.startswith("mix_") and c != "_cum"]
    out = s.filter(F.col("mix_copies") > 0).withColumn(
        "mix_epoch", F.explode(F.sequence(F.lit(0), F.col("mix_copies") - 1)))
    finish = (F.col("mix_epoch") * F.col("mix_source_size") + F.col("_cum")).cast("double") / F.col("mix_target")
    return restored(out.withColumn("mix_finish", finish).select(*names, "mix_epoch", "mix_finish").orderBy("mix_finish"))


def q_op1(spark, sf_dir):
    """Mix all documents: how many words of each the mix takes."""
    s = schedule(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return s.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                    F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


SQL = r"""
WITH d AS (SELECT doc_id, source AS src,
             CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
             md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS k FROM documents),
s AS (SELECT src, CAST(sum(size) AS BIGINT) AS ss FROM d GROUP BY src),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY src NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE
             WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS wt FROM s),
l AS (SELECT *, ((sum(ss) OVER ())::DOUBLE - coalesce(sum(3 * ss) OVER (ORDER BY 3 * ss / wt, src NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
           / sum(wt) OVER (ORDER BY 3 * ss / wt, src NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
      FROM w),
t AS (SELECT src, ss, least((3 * ss)::DOUBLE, (SELECT max(lv) FROM l WHERE lv * wt <= 3 * ss) * wt) AS target FROM l),
q AS (SELECT d.*, t.ss, t.target, sum(size) OVER (PARTITION BY d.src ORDER BY k ROWS UNBOUNDED PRECEDING) AS cum
      FROM d JOIN t ON d.src IS NOT DISTINCT FROM t.src),
c AS (SELECT doc_id, k, size, src, (e.e * ss + cum)::DOUBLE / target AS fin
      FROM q, (VALUES (0), (1), (2)) e(e) WHERE size > 0 AND target > 0),
r AS (SELECT *, sum(size) OVER (ORDER BY fin, src NULLS LAST, k ROWS UNBOUNDED PRECEDING) AS run FROM c),
n AS (SELECT k, sum(size) AS taken FROM r WHERE run <= (SELECT sum(size) FROM d) GROUP BY k)
SELECT q.doc_id, q.size, q.ss AS source_size, q.target, CAST(coalesce(n.taken, 0) AS BIGINT) AS taken
FROM q LEFT JOIN n USING (k)"""
