"""Importance resampling towards a target distribution, features hashed by prefix CRCs.

A document's features are its runs of 1 to ``NGRAM`` consecutive words, hashed by CRC-32 into ``BUCKETS``
buckets. The normalised document (words joined by one space) is scanned once and the running CRC is kept
at the end of each word. The CRC of any run follows from two of these: appending ``k`` bytes to a message
multiplies what came before by ``x^(8k)`` modulo the CRC polynomial over GF(2), so
``crc(b) = crc(a + b) ^ shift(crc(a), len(b))``. The shift is linear; for each power of two of ``k`` it is four
tables of 256 entries, made from the polynomial, and it runs over all words of a batch at once.

The bucket counts of the corpus and of the target are summed up by task before they are shuffled. They
give each bucket a gain in log odds, and each document the sum of its features' gains plus Gumbel noise
from a hash of its id; the highest sums are drawn. The order is global: rows are dealt by range of score,
counted by range, and numbered inside their range.
"""

from __future__ import annotations

import zlib
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corate.llm.common import table, write_stage

NGRAM = 1
BUCKETS = 10_000
SHARE = 10           # per cent of the documents with MIN_WORDS or more
MIN_WORDS = 20
SEED = "2024"
_POLYNOMIAL = 0xEDB88320   # fixed value: CRC-32, reflected
# Letters lower-cased, digits kept, all bytes of characters beyond ASCII kept, everything else a separator.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _step(c: np.ndarray) -> np.ndarray:
    """One zero byte appended: multiplication by x^8."""
    for _ in range(8):
        c = (c >> np.uint32(1)) ^ np.where(c & np.uint32(1), np.uint32(_POLYNOMIAL), np.uint32(0))
    return c


@lru_cache(64)
def _shift_tables(power: int) -> np.ndarray:
    """Shift by ``2^power`` bytes as a table per byte of the CRC: [4, 256]."""
    at = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    return _step(at) if power == 0 else _apply(_shift_tables(power - 1), _apply(_shift_tables(power - 1), at))


def _apply(t: np.ndarray, c: np.ndarray) -> np.ndarray:
    return t[0][c & 255] ^ t[1][(c >> 8) & 255] ^ t[2][(c >> 16) & 255] ^ t[3][c >> 24]


def shift(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``crc`` times x^(8 length): what it adds to the CRC of a message that goes on for ``length`` bytes."""
    crc, power = crc.copy(), 0
    while (length >> power).any():
        on = np.flatnonzero((length >> power) & 1)
        crc[on] = _apply(_shift_tables(power), crc[on])
        power += 1
    return crc


def _prefixes(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Running CRCs at the end of each word of the normalised text (after a first space), and their lengths."""
    words = (text or b"").translate(_NORMAL).split()
    ends = np.fromiter(accumulate(words, lambda c, w: zlib.crc32(b" " + w, c), initial=0), np.uint32, len(words) + 1)
    return ends, np.fromiter(map(len, words), np.int64, len(words))


def ngram_crcs(texts: list, n: int = NGRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC-32 of every run of 1 to ``n`` words, the index of its text, and the words of each text."""
    got = [_prefixes(t) for t in texts]
    count = np.array([len(x[1]) for x in got], np.int64)
    if not count.sum():
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), count
    doc = np.repeat(np.arange(len(texts)), count)
    end = np.concatenate([e[1:] for e, _ in got])
    before = np.concatenate([e[:-1] for e, _ in got])
    size = np.concatenate([x for _, x in got])
    # The CRC just after the space that stands before each word.
    start = _apply_byte(before, 32)
    total = np.cumsum(size + 1)
    crcs, docs = [], []
    for k in range(min(n, int(count.max()))):
        last = np.arange(k, len(doc))
        first = last - k
        same = doc[last] == doc[first]
        last, first = last[same], first[same]
        length = total[last] - total[first] + size[first]
        crcs.append(end[last] ^ shift(start[first], length))
        docs.append(doc[last])
    return np.concatenate(crcs), np.concatenate(docs), count


def _apply_byte(crc: np.ndarray, byte: int) -> np.ndarray:
    """``zlib.crc32(bytes([byte]), crc)`` for each element."""
    full = np.uint32(0xFFFFFFFF)
    return _step((crc ^ full) ^ np.uint32(byte)) ^ full


def _hashed(n: int, buckets: int):
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def hashed(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            crcs, doc, words = ngram_crcs(texts, n)
            each = np.bincount(doc, minlength=len(texts))
            data = (crcs % buckets).astype(kind)[np.argsort(doc, kind="stable")]
            cut = np.concatenate([[0], np.cumsum(each)])
            packed = [data[cut[i]: cut[i + 1]].tobytes() for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(each, pa.int64()), pa.array(packed, pa.binary())],
                                             names=["_id", "words", "n_features", "features"])
    return hashed


def features(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """``(_id, words, n_features, features)``: the buckets of all word runs as packed unsigned integers (16 bits,
    32 for more than 65,536 buckets). A null text has no words; texts of any length are whole."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").cast("binary").alias("_text")).mapInArrow(
        _hashed(n, buckets), f"_id {kind}, words long, n_features long, features binary")


def bucket_counts(hashed: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, count)`` of the buckets that occur: each task adds up its documents first."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def counted(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.bincount(np.frombuffer(x.as_py(), kind), minlength=buckets)
        on = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(on, pa.int64()), pa.array(total[on])], names=["bucket", "count"])

    return hashed.select("features").mapInArrow(counted, "bucket long, count long").groupBy("bucket").agg(F.sum("count").alias("count"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, gain)`` for all buckets: floor(1000 ln(odds of the bucket in the target over the source)),
    one added to each count."""
    spark = source.sparkSession
    s, t = (x.select("bucket", F.col("count").alias(c)) for x, c in ((source, "s"), (target, "t")))
    all_ = spark.range(buckets).withColumnRenamed("id", "bucket").join(s, "bucket", "left").join(t, "bucket", "left").fillna(0, ["s", "t"])
    total = all_.agg(F.struct(F.sum("s").alias("s"), F.sum("t").alias("t"))).scalar()
    d = lambda c: c.cast("double")
    odds = (d(F.col("t")) + 1) * (d(total["s"]) + buckets) / ((d(F.col("s")) + 1) * (d(total["t"]) + buckets))
    return all_.select("bucket", F.floor(F.lit(1000.0) * F.log(odds)).alias("gain"))


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             n: int = NGRAM, buckets: int = BUCKETS, share: float = SHARE, min_words: int = MIN_WORDS, seed: str = SEED) -> DataFrame:
    """Every row of ``docs`` as ``(id, n_features, weight, score, rank)``: ``rank`` counts the drawn ones from the
    highest score, ties by the smaller id, and is null for the others. ``share`` per cent of the documents with
    ``min_words`` or more are drawn (rounded down).

    A null or empty text has no features and weighs 0. A null id is hashed as an empty one and comes last of
    equal scores; of an id listed several times each row may be drawn, and rows that are equal are interchangeable.
    An empty target or corpus gives even odds where nothing was counted. Other columns are ignored."""
    spark = docs.sparkSession
    hashed = write_stage(features(docs, id_col=id_col, text_col=text_col, n=n, buckets=buckets), "resample-features")
    wanted = features(target.withColumn("_none", F.lit(0)), id_col="_none", text_col=target_text, n=n, buckets=buckets)
    gain = np.zeros(buckets, np.int64)
    for r in gains(bucket_counts(hashed, buckets), bucket_counts(wanted, buckets), buckets).toLocalIterator():  # as many as buckets
        gain[r["bucket"]] = r["gain"]
    gain = spark.sparkContext.broadcast(gain)
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def weighed(batches):
        for batch in batches:
            w = [int(gain.value[np.frombuffer(x.as_py(), kind)].sum()) for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(w, pa.int64())], names=["_id", "words", "n_features", "weight"])

    id_type = hashed.schema["_id"].dataType.simpleString()
    d = hashed.mapInArrow(weighed, f"_id {id_type}, words long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    d = d.withColumn("score", F.col("weight") + noise).withColumn("_in", F.col("words") >= min_words)
    order = [F.col("_in").desc(), F.col("score").desc(), F.col("_id").asc_nulls_last()]
    d = write_stage(d.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "resample-scores")
    parts = d.groupBy("_part").agg(F.count("*").alias("_n"), F.count(F.when(F.col("_in"), 1)).alias("_able"))
    # One row per partition of the range sort.
    parts = parts.withColumn("_before", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).withColumn("_able", F.sum("_able").over(Window.partitionBy()))
    d = d.join(F.broadcast(parts.drop("_n")), "_part")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_before")
    drawn = F.floor(F.lit(share) * F.col("_able") / 100)
    return d.withColumn("_place", place).select(
        F.col("_id").alias(id_col), "n_features", "weight", "score", F.when(F.col("_in") & (F.col("_place") <= drawn), F.col("_place")).cast("long").alias("rank"))


def q_op12(spark, sf_dir):
    """All documents weighed towards the benchmark."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# CRC-32 of each different word, byte by byte through a table made from the polynomial.
_WORDS = r"regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {_POLYNOMIAL}) ELSE c >> 1 END, i::BIGINT)) AS t),
d AS (SELECT doc_id, unnest({_WORDS.format(t="coalesce(text, '')")}) AS w FROM documents),
b AS (SELECT unnest({_WORDS.format(t="coalesce(text, '')")}) AS w FROM benchmark),
v AS (SELECT DISTINCT w FROM (SELECT w FROM d UNION ALL SELECT w FROM b)),
c AS (SELECT w, xor(list_reduce(list_transform(range(length(hex(encode(w))) // 2), lambda i: ('0x' || substr(hex(encode(w)), 2 * i::BIGINT + 1, 2))::BIGINT),
    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) % {BUCKETS} AS bucket FROM v, tab),
s AS (SELECT bucket, count(*) AS n FROM d JOIN c USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN c USING (w) GROUP BY bucket),
g AS (SELECT c.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + {BUCKETS})::DOUBLE
      / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
    FROM (SELECT DISTINCT bucket FROM c) c LEFT JOIN s ON s.bucket = c.bucket LEFT JOIN t ON t.bucket = c.bucket),
f AS (SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM d JOIN c USING (w) JOIN g USING (bucket) GROUP BY doc_id),
x AS (SELECT o.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
      coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || o.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM documents o LEFT JOIN f ON f.doc_id = o.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {MIN_WORDS} ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_features >= {MIN_WORDS}) AS able FROM x)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {MIN_WORDS} AND place <= {SHARE} * able // 100 THEN place END AS rank FROM r"""
