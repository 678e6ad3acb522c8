"""All operators that pass other columns through, and all that do not, on the same odd tables."""

import random

import pytest
from pyspark.sql import functions as F

from corate.llm import bitsliced, conversation, decontam, licenses, lm, mixing, neardup, neighbours, pii, resampling, tokens, toxicity, warc
from corate.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "Many words and 12 numbers follow here, for Anna and mail x@example.com. " * 1_400   # 100 kB
# Names that the operators use inside.
CLASHES = ["_k1", "_K2", "_t", "_gi", "_gone_id", "_size", "_key", "_cum", "_spans", "_new", "_p", "_dir", "_license", "_near", "_id", "_words", "p_toxic",
           "mix", "_src", "_target", "_h", "_item", "kept_k1", "feature", "kind"]


def rows():
    base = "One plain text with some ordinary words that stands here twice and once again."
    return [(1, base, "en", "a", 1), (1, base, "en", "a", 1), (2, base, "en", "b", 1), (3, None, None, None, None), (4, "", "en", "a", 0), (None, "no id", "de", "a", 5),
            (5, LONG, "en", "b", len(LONG)), (6, " \t\n", "en", "b", 3)]


BENCH = [(1, "A farmer named Hans sells 12 apples and 7 pears to Maria for 30 dollars each morning before Hans walks home."), (2, None), (2, "")]
LABELS = [(1, 1, 0), (2, 0, 0), (None, 1, 0), (4, None, None)]


def wide(df):
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])


def passing(spark):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    with_path = lambda d: d.withColumn("path", F.concat(F.lit("a/b/"), F.col("doc_id")))
    return {
        "mix": mixing.mix, "schedule": mixing.schedule, "deduplicate": neardup.deduplicate, "sanitise": pii.sanitise,
        "decontaminate": lambda d: decontam.decontaminate(d, bench), "reject_toxic": lambda d: toxicity.reject_toxic(d, labels),
        "scan": lambda d: licenses.scan(with_path(d)),
    }


@pytest.mark.parametrize("name", ["mix", "schedule", "deduplicate", "sanitise", "decontaminate", "reject_toxic", "scan"])
def test_other_columns_pass_through(spark, name):
    f = passing(spark)[name]
    d = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    out = f(wide(d))
    assert set(CLASHES) <= set(out.columns)
    got, plain = out.collect(), f(d).collect()
    assert len(got) == len(plain) > 0
    assert all(r[c] == i for r in got for i, c in enumerate(CLASHES))
    told = [c for c in f(d).columns]
    assert sorted(str([r[c] for c in told]) for r in got) == sorted(str([r[c] for c in told]) for r in plain)
    assert f(wide(d.limit(0))).count() == 0


def reporting(spark):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    turns = lambda d: d.select("*", F.col("doc_id").alias("conv_id"), F.col("n_chars").alias("turn"), F.col("lang").alias("role"))
    vectors = lambda d: d.select("*", F.col("doc_id").alias("vec_id"), F.array(F.col("doc_id").cast("double"), F.lit(1.0)).alias("embedding"))
    pages = lambda d: d.select("*", F.col("doc_id").alias("page_id"), F.col("lang").alias("url"), F.col("text").alias("html"))
    return {
        "near_duplicates": (neardup.near_duplicates, 8), "scores": (lm.scores, 8), "find": (pii.find, 8),
        "contaminated": (lambda d: decontam.contaminated(d.select("doc_id", "text"), bench), 0),
        "score": (lambda d: toxicity.score(d.select("doc_id", "text"), labels), 8),
        "archives": (lambda d: warc.read_archives(spark, warc.write_archives(pages(d), scratch_path(spark, "w"))), 8),
        "tokens": (lambda d: tokens.count_tokens(spark, tokens.write_token_files(d, scratch_path(spark, "t"))), 8),
        "nearest": (lambda d: neighbours.nearest(vectors(d), vectors(d)), None), "audit": (lambda d: conversation.audit(turns(d)), 7),
        "resample": (lambda d: resampling.resample(d, bench), 8), "top_k": (lambda d: bitsliced.top_k(vectors(d), vectors(d)), None),
    }


@pytest.mark.parametrize("name", ["near_duplicates", "scores", "find", "contaminated", "score", "archives", "tokens", "nearest", "audit", "resample", "top_k"])
def test_odd_tables(spark, name):
    """Repeated rows, nulls, empty texts and one of 100 kB; no rows; the same rows in another order."""
    f, n = reporting(spark)[name]
    d = wide(spark.createDataFrame(rows(), SCHEMA))
    got = f(d.repartition(3))
    drop = [c for c in ("file", "start") if c in got.columns]   # the place in an archive
    a, b = (sorted(map(str, x.drop(*drop).collect())) for x in (got, f(d.repartition(2))))
    assert a == b and (n is None and a or len(a) == n)
    assert f(d.limit(0)).count() == 0


def test_large_buckets_lose_no_link(spark, monkeypatch):
    """All buckets taken as large give the classes that all pairs of the buckets give."""
    r = random.Random(5)
    core = [f"c{i}" for i in range(60)]

    def text():
        w = list(core)
        for _ in range(r.choice([1, 1, 2])):
            at = r.randrange(0, 56)
            w[at] = f"x{r.randrange(12)}"
        return " ".join(w)
    docs = spark.createDataFrame([(i, text()) for i in range(90)], "doc_id long, text string")
    monkeypatch.setattr(neardup, "DAMPING", 0.0)

    def run(each):
        monkeypatch.setattr(neardup, "EACH", each)
        return sorted(tuple(x) for x in neardup.near_duplicates(docs, least=0.75).collect())
    assert run(0) == run(10 ** 9)
