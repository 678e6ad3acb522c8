"""Last-write-wins deduplication and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
                  values: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the one with the greatest ``order_by`` tuple (latest write).

    Expressed as ``groupBy(keys).agg(max_by(struct(rest), struct(order_by)))`` rather than a
    ``row_number`` window: the aggregate combines map-side before the shuffle, so a key with
    many versions does not send all of them to one task. A struct buffer makes it a sort aggregate:
    each side of the shuffle is sorted by key.
    Nulls in the ordering rank lowest (as ``ORDER BY ... DESC NULLS LAST``). ``values`` limits the
    carried columns (default: all non-key columns); the aggregation buffer holds only those.
    """
    keys = list(keys)
    rest = list(values) if values is not None else [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    order = F.struct(*_cols(order_by))
    latest = F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_latest")
    return df.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in rest])


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
           order_by: Sequence[str | Column] = ()) -> DataFrame:
    """``existing`` with ``incoming`` applied, last write wins per key.

    Incoming rows replace existing rows of the same key; within the batch the greatest ``order_by``
    tuple wins, then the greatest values, so ties do not depend on the order of the rows. ``existing``
    is a stored table, unique per key: it is only filtered (anti join with the batch's keys, which
    Spark broadcasts when they are small), never shuffled for a small batch. Columns are matched
    by name.
    """
    cols = existing.columns
    rest = [c for c in cols if c not in keys]
    new = latest_by_key(incoming.select(*cols), keys, [*_cols(order_by), *_cols(rest)]).select(*cols)
    return existing.select(*cols).join(new.select(*keys), list(keys), "left_anti").unionByName(new)


def upsert_items(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Item catalog upsert on ``item_id``; the incoming title replaces the stored one."""
    return upsert(existing, incoming, ["item_id"])


def upsert_ratings(existing: DataFrame, incoming: DataFrame,
                   order_by: Sequence[str | Column] = ()) -> DataFrame:
    """Rating upsert on ``(user_id, item_id)``; incoming wins, ties inside a batch by ``order_by``."""
    return upsert(existing, incoming, ["user_id", "item_id"], order_by)
