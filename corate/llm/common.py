"""Shared helpers of the training-data operators: tokens, row keys, written stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corate.session import scratch_path

# Fixed value: a word is a maximal run of characters other than space and U+0009..U+000D.
SPACE = r"[\x20\x09-\x0D]+"


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words(col: str | Column = "text") -> Column:
    """The words of a text in order (null: none)."""
    c = text_or_empty(col) if isinstance(col, str) else col
    return F.array_remove(F.split(c, SPACE), "")


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared scratch folder and read back: cuts the lineage, and a
    lost executor costs one stage. Unlike a local checkpoint the files outlive their executor."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def drop_stage(df: DataFrame) -> None:
    """Delete the files of a stage that nothing will read any more."""
    path = getattr(df, "_stage_path", None)
    if path:
        spark: SparkSession = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def small_broadcast(df: DataFrame, rows: int, row_bytes: int, max_bytes: int = 32 << 20) -> DataFrame:
    """``df`` hinted for broadcast if its counted ``rows`` prove it small; otherwise unchanged, so
    that the join shuffles (and adaptive execution splits skewed keys)."""
    return F.broadcast(df) if rows * row_bytes <= max_bytes else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_``, ``name__``, ... that is no column of ``df`` (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shielded(df: DataFrame, *own: str):
    """``df`` with its columns that start with ``_`` (but not ``own``) under other names, as the operators use such
    names inside, and a function that gives a result with those columns their names back."""
    held, taken = {}, df
    for c in df.columns:
        if c.startswith("_") and c not in own:
            held[c] = free_name(taken, f"kept{c}")
            taken = taken.withColumnRenamed(c, held[c])
    back = {v: k for k, v in held.items()}
    return taken, lambda out: out.withColumnsRenamed(back) if back else out
