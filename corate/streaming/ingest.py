"""Incremental rating ingestion with Structured Streaming.

Rating log files arriving in a directory are parsed as they come and appended, micro-batch by
micro-batch, to a table of rating events; rejected lines go to a side table. Each micro-batch is
written to its own ``batch_id=N`` directory with overwrite, so a batch replayed after a failure
replaces its earlier attempt (exactly-once output with the checkpointed file source). The current
ratings are read with last-write-wins per ``(user_id, item_id)`` (merge on read); ``compact``
writes them out as a plain table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from corate.operators.dedupe import latest_by_key
from corate.sources.readers import rating_fields, split_rating_fields


def _batch_writer(table_path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        # Two outputs from one micro-batch: keep the parsed batch for the second write (a lost
        # block is recomputed from the batch's source files).
        batch.persist()
        try:
            good, rejects = split_rating_fields(batch, with_timestamp=True)
            good.write.mode("overwrite").parquet(f"{table_path}/good/batch_id={batch_id}")
            rejects.write.mode("overwrite").parquet(f"{table_path}/rejects/batch_id={batch_id}")
        finally:
            batch.unpersist()
    return write


def start_rating_ingest(spark: SparkSession, source_dir: str, table_path: str, checkpoint_path: str, *,
                        available_now: bool = True, processing_time: str | None = None,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start ingesting rating log lines ``user,item,rating,ts`` from files under ``source_dir``.

    ``available_now`` processes what is there and stops (catch-up runs); otherwise pass
    ``processing_time`` (e.g. ``'1 minute'``) for a continuously running query.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    fields = rating_fields(reader.load(source_dir))
    writer = (fields.writeStream.foreachBatch(_batch_writer(table_path))
              .option("checkpointLocation", checkpoint_path))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def rating_events_table(spark: SparkSession, table_path: str) -> DataFrame:
    """All ingested rating events ``(user_id, item_id, rating, ts, batch_id)``."""
    return spark.read.parquet(f"{table_path}/good")


def rejected_lines(spark: SparkSession, table_path: str) -> DataFrame:
    """All rejected lines ``(line, reason, batch_id)``."""
    return spark.read.parquet(f"{table_path}/rejects")


def current_ratings(spark: SparkSession, table_path: str, *, order: str = "event_time") -> DataFrame:
    """Latest rating per ``(user_id, item_id)``.

    ``order='event_time'``: greatest ``ts`` wins, later batch breaks ties, so late files cannot
    overwrite newer ratings. ``order='arrival'``: the later batch wins, then ``ts`` (plain
    last-write-wins).
    """
    ev = rating_events_table(spark, table_path)
    # The rating itself comes last: equal times in one batch must not depend on the order of the rows.
    keys = [*(["ts", "batch_id"] if order == "event_time" else ["batch_id", "ts"]), "rating"]
    return latest_by_key(ev, ["user_id", "item_id"], keys).select("user_id", "item_id", "rating")


def compact(spark: SparkSession, table_path: str, out_path: str, *, order: str = "event_time") -> str:
    """Write the current ratings as a plain table (overwrite) and return its path."""
    current_ratings(spark, table_path, order=order).write.mode("overwrite").parquet(out_path)
    return out_path
