"""Tables with a layout: clustered for lookups, bucketed for upserts, counted as they are written."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corate.operators.dedupe import upsert
from corate.session import materialize

ROWS_PER_FILE = 8_000_000
ROWS_PER_GROUP = 250_000


def write_observed(df: DataFrame, path: str, if_exists: str = "overwrite", partition_by: Sequence[str] = (), **metrics: Column) -> dict:
    """Write ``df`` as Parquet and return ``{"rows": n, **metrics}``, counted by the write itself
    (``DataFrame.observe``), so that no second job reads the table for its figures."""
    seen = Observation()
    w = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in metrics.items()]).write.mode(if_exists)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return seen.get


def write_clustered(df: DataFrame, path: str, by: Sequence[str] = ("item_id", "user_id"), *, bloom: Sequence[str] = ("item_id", "user_id"),
                    rows: int | None = None, rows_per_file: int = ROWS_PER_FILE, rows_per_group: int = ROWS_PER_GROUP) -> str:
    """Write ``df`` range partitioned and sorted by ``by``, in row groups of ``rows_per_group`` rows with a Parquet
    Bloom filter on each column of ``bloom``.

    A condition on the leading key is answered by the row groups' least and greatest values, one on another
    key by their Bloom filters; both are read from the files' footers, before any data. A leading key with
    more rows than a file is split by the next one. ``rows`` saves counting them."""
    n = df.count() if rows is None else rows
    d = df.repartitionByRange(max(1, math.ceil(n / rows_per_file)), *by).sortWithinPartitions(*by)
    w = d.write.mode("overwrite").option("parquet.block.row.count.limit", rows_per_group)
    for c in bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", rows_per_group)
    w.parquet(path)
    return path


_BUCKET = re.compile(r"bucket_of_(\d+)")


def _bucket_column(df: DataFrame) -> tuple[str, int]:
    found = [c for c in df.columns if _BUCKET.fullmatch(c)]
    if not found:
        raise ValueError("not a table written by create_bucket_table")
    return found[0], int(_BUCKET.fullmatch(found[0])[1])


def _bucket(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def create_bucket_table(df: DataFrame, path: str, keys: Sequence[str], n_buckets: int) -> str:
    """Write ``df``, unique by ``keys``, as a table partitioned by a hash of the keys. The number of buckets is part
    of the partition column's name, so later batches deal their rows alike."""
    name = f"bucket_of_{n_buckets}"
    df.withColumn(name, _bucket(keys, n_buckets)).repartition(n_buckets, name).write.mode("overwrite").partitionBy(name).parquet(path)
    return path


def read_bucket_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table written by ``create_bucket_table``."""
    df = spark.read.parquet(path)
    return df.drop(_bucket_column(df)[0])


def upsert_bucket_table(spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ()) -> list[int]:
    """Apply ``incoming`` to the table at ``path``, last write wins per key; returns the buckets written.

    Only buckets that the batch names are read (partition pruning) and replaced (dynamic partition
    overwrite); the files of all others stay as they are. The batch and the new buckets are written to the
    shared scratch folder first, so a failed run leaves the table as it was or can be repeated: the same batch
    applied twice gives the same table."""
    table = spark.read.parquet(path)
    name, n = _bucket_column(table)
    cols = [c for c in table.columns if c != name]
    batch = materialize(incoming.select(*cols).withColumn(name, _bucket(keys, n)), "upsert_batch")
    touched = sorted(r[0] for r in batch.select(name).distinct().take(n))
    if touched:
        merged = upsert(table.filter(F.col(name).isin(touched)), batch, [*keys, name], order_by)
        merged = materialize(merged.select(*cols, name), "upsert_buckets")
        (merged.repartition(len(touched), name).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(name).parquet(path))
    return touched
