"""Writers: Parquet tables (overwrite / append / create-if-missing, run-stamped paths), the
similarity and packed-row text formats, recommendation text and CSV item exports."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.functions.scalars import DEFAULT_TITLE_MARKER, pack_entries, title_has_marker
from corate.operators.recommend import format_recommendations
from corate.session import materialize

_MODES = {"overwrite": "overwrite", "append": "append", "error": "errorifexists", "ignore": "ignore"}


def run_path(base: str, run_id: str | int | None = None) -> str:
    """``base/run=<id>``; the id defaults to the current epoch nanosecond, so that runs sort by time and two
    runs of one second do not meet."""
    rid = time.time_ns() if run_id is None else run_id
    return f"{base.rstrip('/')}/run={rid}"


def key_ordered(df: DataFrame, keys: list[str | Column], partitions: int | None = None) -> DataFrame:
    """Range partitioned and sorted by ``keys``: part files in name order hold ascending keys
    (the layout of sorted reducer output). Range bounds come from a sample of the keys; no
    single task sorts everything. ``partitions`` fixes the file count (else AQE sizes it)."""
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def write_table(df: DataFrame, path: str, if_exists: str = "overwrite", *,
                partition_by: list[str] | None = None, sort_within: list[str] | None = None,
                order_by: list[str] | None = None) -> str:
    """Write ``df`` as a Parquet table, one file per task.

    ``if_exists``: ``overwrite`` (drop and recreate), ``append`` (create if missing, else add),
    ``error`` or ``ignore``. ``sort_within`` sorts each file by those columns; ``order_by``
    orders the whole output across files (``key_ordered``). Returns ``path``.
    """
    w = key_ordered(df, order_by) if order_by else df
    w = w.sortWithinPartitions(*sort_within) if sort_within else w
    writer = w.write.mode(_MODES[if_exists])
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


# Ratings per bucket when the bucket count is derived from the data. A stage that reads one bucket per task should
# do some seconds of work: with less, tasks, files and (times the reducers) shuffle blocks outgrow the ratings.
DEFAULT_ROWS_PER_BUCKET = 1 << 16


def write_bucketed(df: DataFrame, table: str, path: str, n_buckets: int | None = None, by: str = "user_id",
                   if_exists: str = "overwrite", rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> str:
    """Write ``df`` as a table bucketed (hash partitioned) and sorted by ``by``, stored at ``path``
    and registered in the session catalog as ``table``; returns the table name.

    Jobs that read it with ``spark.table(table)`` get the ``by`` partitioning from the scan: a join
    or aggregate on ``by`` needs no exchange (pass ``user_partitioned=True`` to the similarity and
    scoring operators so they keep it). Without ``n_buckets`` the count is ``rows / rows_per_bucket``
    (one count of ``df``; cheap on a written table), at least the session's shuffle partitions.
    The rows are hash partitioned into the buckets first, so every bucket is one file.
    """
    if n_buckets is None:
        from corate.plans.skew import partitions_for
        n_buckets = partitions_for(df.sparkSession, df.count(), rows_per_bucket)
    (df.repartition(n_buckets, by).write.mode(_MODES[if_exists]).bucketBy(n_buckets, by).sortBy(by)
     .option("path", path).saveAsTable(table))
    return table


def similarity_lines(sim: DataFrame) -> DataFrame:
    """``'item_1 item_2<TAB>similarity n_ratings'`` lines; doubles print in shortest round-trip form."""
    return sim.select(F.concat_ws(
        "", F.col("item_1").cast("string"), F.lit(" "), F.col("item_2").cast("string"), F.lit("\t"),
        F.col("similarity").cast("string"), F.lit(" "), F.col("n_ratings").cast("string"),
    ).alias("value"))


def pair_key(item_1: str = "item_1", item_2: str = "item_2") -> Column:
    """The text key of a similarity line, ``'item_1 item_2'``."""
    return F.concat_ws(" ", F.col(item_1).cast("string"), F.col(item_2).cast("string"))


def write_similarity(sim: DataFrame, path: str, if_exists: str = "overwrite", *, ordered: bool | str = False,
                     partitions: int | None = None) -> str:
    """Similarity text. ``ordered=True`` writes the pairs in ascending ``(item_1, item_2)`` across files,
    ``ordered="text"`` in the order of their text keys (``'1 10' < '1 9'``), as sorted text keys stand."""
    src = sim
    if ordered:
        src = key_ordered(sim, [pair_key()] if ordered == "text" else ["item_1", "item_2"], partitions)
    similarity_lines(src).write.mode(_MODES[if_exists]).text(path)
    return path


def packed_lines(packed: DataFrame, key: str) -> DataFrame:
    """``'key<TAB><TAB>(col<TAB>val)...'`` lines (the packed value starts with a tab)."""
    return packed.select(F.concat(F.col(key).cast("string"), F.lit("\t"), F.col("packed")).alias("value"))


def write_packed(packed: DataFrame, key: str, path: str, if_exists: str = "overwrite") -> str:
    packed_lines(packed, key).write.mode(_MODES[if_exists]).text(path)
    return path


# A key with more entries than this is dealt by column range, so that no task holds the whole key.
DEFAULT_HOT_ENTRIES = 1 << 20
# Entries joined to one string at a time.
PIECE_ENTRIES = 1 << 12


def write_packed_lines(df: DataFrame, key: str, col: str, val: str, path: str, if_exists: str = "overwrite", *,
                       partitions: int | None = None, hot_entries: int = DEFAULT_HOT_ENTRIES) -> str:
    """Packed text ``'key<TAB><TAB>(col<TAB>val)...'`` with one line per key, columns ascending, however wide the ids
    and however long the row.

    The entries are range partitioned by key and sorted; a task joins them in pieces of at most
    ``PIECE_ENTRIES`` and its file joins the pieces to lines: ``)`` ends every piece and is the row separator of the
    text writer, and a piece that begins a line starts with a line break. So no group holds a whole row.
    A key with more than ``hot_entries`` entries is dealt by column range as well. It then has one line in each of
    several files, which follow each other by name and by column."""
    counts = df.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_entries).select(key, F.lit(True).alias("_hot"))
    d = df.select(key, col, val).join(counts, key, "left").withColumn("_by", F.when(F.col("_hot"), F.col(col)))
    order = [F.col(key), F.col("_by"), F.col(col)]
    d = (d.repartitionByRange(partitions, *order[:2]) if partitions else d.repartitionByRange(*order[:2])).sortWithinPartitions(*order)
    d = materialize(d.select(key, col, val, F.monotonically_increasing_id().alias("_pos")), "packed_entries")
    part, row = F.shiftright("_pos", 33), F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1))
    piece = (row / PIECE_ENTRIES).cast("long")
    entries = F.array_sort(F.collect_list(F.struct("_pos", F.col(col).alias("c"), F.col(val).alias("v"))))
    pieces = d.groupBy(key, part.alias("_part"), piece.alias("_piece")).agg(entries.alias("_e"))
    # The first piece of a key in its file begins a line, and so a new one unless it is the file's first.
    starts = d.groupBy(key, part.alias("_part")).agg(F.min("_pos").alias("_start"))
    pieces = pieces.join(starts, [key, "_part"])
    at = F.element_at("_e", 1)["_pos"]
    text = F.expr("substr(_packed, 1, length(_packed) - 1)")
    head = F.when(at != F.col("_start"), "").otherwise(
        F.concat(F.when(at.bitwiseAND(F.lit((1 << 33) - 1)) == 0, "").otherwise("\n"), F.col(key).cast("string"), F.lit("\t")))
    lines = pieces.withColumn("_packed", pack_entries("_e", "c", "v")).select("_part", at.alias("_at"), F.concat(head, text).alias("value"))
    files = int(d.agg(F.max(part)).first()[0] or 0) + 1
    lines = lines.repartitionById(files, F.col("_part").cast("int")).sortWithinPartitions("_at")
    lines.select("value").write.mode(_MODES[if_exists]).option("lineSep", ")").text(path)
    return path


def write_recommendations(recs: DataFrame, path: str, if_exists: str = "overwrite") -> str:
    """Recommendation text ``'user<TAB><TAB>(item<TAB>score)...'`` in rank order."""
    return write_packed(format_recommendations(recs).withColumnRenamed("recs", "packed"),
                        "user_id", path, if_exists)


def export_items(items: DataFrame, path: str, marker: str | None = DEFAULT_TITLE_MARKER,
                 if_exists: str = "overwrite") -> str:
    """Items whose title carries ``marker`` as quoted CSV with a header (``""`` escapes a quote,
    so titles with commas survive). ``marker=None`` exports everything."""
    out = items if marker is None else items.filter(title_has_marker("title", marker))
    (out.select("item_id", "title", "genres").write.mode(_MODES[if_exists])
     .option("header", True).option("quote", '"').option("escape", '"').csv(path))
    return path
