"""Readers: item catalogs (quoted CSV), rating logs (CSV lines), similarity text, packed rows,
and written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corate.functions.scalars import unpack_entries
from corate.sinks.tables import write_observed

_ITEM_CSV_SCHEMA = T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])


def read_items(spark: SparkSession, path: str, *, header: bool = True) -> DataFrame:
    """Item catalog from quoted CSV ``id,title,genres`` -> ``(item_id bigint, title, genres)``.

    RFC 4180 quoting (a comma inside quotes stays in the title, ``""`` is a quote). Rows with a
    non-numeric id (a header) or without a title (fewer than two fields) are dropped. No line is
    skipped by its position, so files with and without a header may be mixed; ``header`` is kept
    for callers that state it and changes nothing.
    """
    return _item_fields(spark, path).filter("reason is null").select("item_id", "title", "genres")


def _item_fields(spark: SparkSession, path: str) -> DataFrame:
    raw = (spark.read.schema(_ITEM_CSV_SCHEMA).option("header", False)
           .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE").csv(path))
    item_id = F.col("item_id").try_cast("bigint")
    return raw.select(item_id.alias("item_id"), "title", "genres", F.col("item_id").alias("_id"),
                      F.when(F.col("title").isNull(), F.lit("short")).when(item_id.isNull(), F.lit("non_numeric")).alias("reason"))


def item_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``(id, title, genres, reason)`` of the catalog rows that ``read_items`` leaves out, fields as
    read: ``short`` (no title) or ``non_numeric`` (a header line included)."""
    return _item_fields(spark, path).filter("reason is not null").select(F.col("_id").alias("id"), "title", "genres", "reason")


def rating_fields(lines: DataFrame) -> DataFrame:
    """Split rating log lines (column ``value``) into typed fields; works on batch and streaming
    frames alike."""
    plain = F.split(F.col("value"), ",")
    # Quoted lines go through the CSV parser; it keeps the line itself for the rejects.
    csv = F.from_csv(F.col("value"), ", ".join(f"c{i} string" for i in range(4)), {"quote": '"', "escape": '"'})
    quoted = F.filter(F.array(*[csv[f"c{i}"] for i in range(4)]), lambda x: x.isNotNull())
    parts = F.when(F.col("value").contains('"'), quoted).otherwise(plain)
    return lines.select(
        F.col("value").alias("line"),
        F.size(parts).alias("_n"),
        F.get(parts, 0).try_cast("bigint").alias("user_id"),
        F.get(parts, 1).try_cast("bigint").alias("item_id"),
        F.get(parts, 2).try_cast("double").alias("rating"),
        F.get(parts, 3).try_cast("bigint").alias("ts"),
    )


def read_ratings(spark: SparkSession, path: str, *, with_timestamp: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rating log ``userId,itemId,rating[,timestamp]`` lines -> ``(good, rejects)``.

    ``good``: ``(user_id bigint, item_id bigint, rating double)``; the timestamp is dropped unless
    ``with_timestamp`` adds it as ``ts bigint`` (NULL when absent or not a number).
    ``rejects``: ``(line, reason)`` with reason ``short`` (fewer than three fields), ``non_numeric``
    (a header line included) or ``out_of_range`` (a rating that is negative or not finite). Fields may
    be quoted. Both are lazy; writing both reads the log twice (``split_log`` writes them in one pass).
    """
    return split_rating_fields(rating_fields(spark.read.text(path)), with_timestamp=with_timestamp)


def classified(f: DataFrame) -> DataFrame:
    """Typed fields with ``reason``: null for a good line, else why it is rejected (see ``read_ratings``)."""
    bad = F.col("user_id").isNull() | F.col("item_id").isNull() | F.col("rating").isNull()
    r = F.col("rating")
    out = F.coalesce(F.isnan(r) | (r < 0) | (r == float("inf")), F.lit(False))
    reason = F.when(F.col("_n") < 3, F.lit("short")).when(bad, F.lit("non_numeric")).when(out, F.lit("out_of_range"))
    return f.withColumn("reason", reason)


def split_log(spark: SparkSession, path: str, out: str, if_exists: str = "overwrite") -> dict:
    """Read a rating log once and write its good and its rejected lines, as one table at ``out`` partitioned by
    ``status``; returns ``{"rows", "rejected"}``, counted by the write. A good line has its fields
    ``(user_id, item_id, rating, ts)``, a rejected one ``(line, reason)``; ``read_split`` reads them back."""
    f = classified(rating_fields(spark.read.text(path)))
    good = F.col("reason").isNull()
    rows = f.select(*[F.when(good, F.col(c)).alias(c) for c in ("user_id", "item_id", "rating", "ts")],
                    F.when(~good, F.col("line")).alias("line"), "reason", F.when(good, "good").otherwise("rejected").alias("status"))
    return write_observed(rows, out, if_exists, ["status"], rejected=F.count(F.when(F.col("status") == "rejected", True)))


def read_split(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` of a table written by ``split_log``; each reads its own partition only."""
    schema = "user_id long, item_id long, rating double, ts long, line string, reason string, status string"
    t = spark.read.schema(schema).parquet(out)
    return (t.filter("status = 'good'").select("user_id", "item_id", "rating", "ts"),
            t.filter("status = 'rejected'").select("line", "reason"))


def split_rating_fields(f: DataFrame, *, with_timestamp: bool = False) -> tuple[DataFrame, DataFrame]:
    """Typed fields -> ``(good, rejects)``, see ``read_ratings``."""
    c = classified(f)
    cols = ["user_id", "item_id", "rating"] + (["ts"] if with_timestamp else [])
    return c.filter("reason is null").select(*cols), c.filter("reason is not null").select("line", "reason")


def _similarity_fields(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split(F.trim(F.col("value")), r"\s+")
    f = spark.read.text(path).select(
        F.col("value").alias("line"), F.size(parts).alias("_n"),
        F.get(parts, 0).try_cast("bigint").alias("item_1"),
        F.get(parts, 1).try_cast("bigint").alias("item_2"),
        F.get(parts, 2).try_cast("double").alias("similarity"),
        F.get(parts, 3).try_cast("bigint").alias("n_ratings"),
    )
    bad = F.col("item_1").isNull() | F.col("item_2").isNull() | F.col("similarity").isNull()
    return f.withColumn("reason", F.when(F.col("_n") < 3, F.lit("short")).when(bad, F.lit("non_numeric")))


def read_similarity(spark: SparkSession, path: str) -> DataFrame:
    """Similarity text ``item_1 item_2<TAB>similarity n`` (any whitespace) ->
    ``(item_1, item_2, similarity, n_ratings)``; NaN and Infinity parse back. Lines without two ids
    and a similarity are left to ``similarity_rejects``."""
    return _similarity_fields(spark, path).filter("reason is null").select("item_1", "item_2", "similarity", "n_ratings")


def similarity_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``(line, reason)`` of the lines that ``read_similarity`` leaves out: ``short`` (fewer than three
    fields) or ``non_numeric``."""
    return _similarity_fields(spark, path).filter("reason is not null").select("line", "reason")


def read_packed(spark: SparkSession, path: str, key: str = "key") -> DataFrame:
    """Packed text ``key<TAB><TAB>(col<TAB>val)...`` -> ``(key, packed)``."""
    value = F.col("value")
    k = F.substring_index(value, "\t", 1)
    packed = F.expr("substring(value, length(substring_index(value, '\t', 1)) + 2)")
    return spark.read.text(path).select(k.try_cast("bigint").alias(key), packed.alias("packed"))


def read_packed_entries(spark: SparkSession, path: str, key: str = "key", col: str = "col", val: str = "val", *,
                        last_wins: bool = False) -> DataFrame:
    """Packed text straight to long form ``(key, col, val)``. With ``last_wins`` the last entry of a
    column that a line repeats stands for it, at the price of a shuffle; a key has one line then."""
    rows = read_packed(spark, path, key)
    e = rows.select(key, F.posexplode(unpack_entries("packed")).alias("_pos", "_e"))
    out = e.select(key, "_pos", F.col("_e.key").alias(col), F.col("_e.value").alias(val))
    if last_wins:
        out = out.groupBy(key, col).agg(F.max_by(val, "_pos").alias(val))
    return out.select(key, col, val)


def dump_table(spark: SparkSession, path: str) -> DataFrame:
    """Every row of a table written by ``write_table``."""
    return spark.read.parquet(path)
