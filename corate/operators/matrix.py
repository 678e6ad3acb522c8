"""Two joins of sparse rows: packed rows against a broadcast matrix, and a blocked sparse product.

Packed. The matrix is held as one row per item with two arrays (columns and values), cut into pieces of
at most ``MAX_ENTRIES``. A rating meets its item's arrays with one hash lookup and they are expanded behind the
join, in the same generated code as the aggregate. An entry costs 12 bytes instead of a hash row, and the size
that decides the broadcast is computed from the row lengths in bytes.

Blocked. For a matrix too large to broadcast, users are dealt into ``n_u`` blocks and matrix columns into
``n_j``: cell ``(u, j)`` gets the ratings of its users and the matrix entries of its columns, joins them on the
item and holds every score of its users and columns complete. The partial products, which outnumber both
inputs, never cross the network; ratings are sent ``n_j`` times and entries ``n_u`` times, in lists per user and
per item, with the blocks chosen to make that sum least. A cell is as large as the aggregate of its scores allows;
how many products go into a score is told from some users. An item with many raters and a long row is spread over
all cells by itself.
A user whose products would fill a cell is cut by item, and only the scores of such users are summed once more.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, IntegerType, LongType, ShortType

from corate.operators.vectors import SEGMENT_WIDTH
from corate.plans.skew import DEFAULT_MAX_HOT_KEYS, SCORING_ROWS_PER_TASK, default_partitions
from corate.session import materialize

# Entries in one packed piece: a longer matrix row is several pieces of one item.
MAX_ENTRIES = 1 << 16
# Cells are planned to this share of the rows a task may make, as blocks dealt by hash are uneven.
CELL_FILL = 0.5
# A user with more products in a cell than this share of it is cut by item.
USER_FILL = 0.125
# The users whose products and scores are counted to size the cells have about so many products and ratings at most.
SAMPLE_PRODUCTS, SAMPLE_RATINGS = 8_000_000, 100_000
# A cell has at most so many products for each score it may hold, which bounds its time.
MAX_PRODUCTS_PER_SCORE = 64
# Bytes of a cell's matrix entries in the hash table of its join.
CELL_MATRIX_BYTES = 128 * 1024 * 1024
# Bytes of a row that a user sends on from a column block (its best scores).
KEPT_ROW_BYTES = 10


INTEGRAL = (ByteType, ShortType, IntegerType, LongType)


@dataclass(frozen=True)
class Narrow:
    """Columns of a matrix as ints from ``low`` (``None``: as they are), and values as bytes if ``small``: 5 bytes an
    entry instead of 12 where all of them fit."""

    low: int | None = None
    small: bool = False
    item_type: DataType | None = None

    @property
    def widths(self) -> tuple[int, int]:
        return (8 if self.low is None else 4), (1 if self.small else 4)

    def column(self, item: Column) -> Column:
        return item if self.low is None else (item - F.lit(self.low).cast("long")).cast("int")

    def item(self, column: Column) -> Column:
        return column if self.low is None else (column.cast("long") + F.lit(self.low).cast("long")).cast(self.item_type)

    def value(self, val: Column) -> Column:
        return val.cast("byte") if self.small else val

    def entries(self, v: DataFrame) -> DataFrame:
        return v.select("item_1", self.column(F.col("item_2")).alias("item_2"), self.value(F.col("val")).alias("val"))

    def arrays(self, packed: DataFrame) -> DataFrame:
        """``entries`` of rows that are packed already."""
        return packed.select("item_1", F.transform("cols", self.column).alias("cols"), F.transform("vals", self.value).alias("vals"))


def narrow(item_type: DataType, low: int | None, high: int | None, least: int | None, most: int | None) -> Narrow:
    """The narrowest form that holds all items of ``low`` to ``high`` and values of ``least`` to ``most``."""
    fits = isinstance(item_type, INTEGRAL) and low is not None and high - low < 1 << 31
    small = least is not None and least >= -128 and most <= 127
    return Narrow(low if fits else None, small, item_type)


def packed_bytes(entries: Column, widths: tuple[int, int] = (8, 4)) -> Column:
    """Bytes of a packed row of that many entries in a broadcast table: a column and a value (by default a bigint and
    an int) each with their null bits, two array heads, the row itself with its item and the slot of the hash table."""
    bits = F.ceil(entries / 64) * 8
    data = [F.ceil(entries * width / 8) * 8 for width in widths]
    return (16 + 2 * bits + data[0] + data[1] + 8 + 3 * 8 + 8 + 32).cast("long")


def pack_matrix(v: DataFrame, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """``(item_1, cols, vals)`` of ``(item_1, item_2, val)``: parallel arrays, at most about ``max_entries`` long.
    Longer rows are dealt into pieces by a hash of the column, so that no group holds a whole long row."""
    lengths = v.groupBy("item_1").agg(F.ceil(F.count("*") / max_entries).cast("int").alias("_pieces")).filter("_pieces > 1")
    d = v.select("item_1", "item_2", "val").join(lengths, "item_1", "left")
    piece = F.coalesce(F.pmod(F.xxhash64("item_2"), F.col("_pieces").cast("long")), F.lit(0))
    rows = d.groupBy("item_1", piece.alias("_piece")).agg(F.collect_list(F.struct("item_2", "val")).alias("_e"))
    return rows.select("item_1", F.col("_e.item_2").alias("cols"), F.col("_e.val").alias("vals"))


def packed_scores(w: DataFrame, packed: DataFrame, *, how: str = "inner", seen: bool = False, form: Narrow = Narrow()) -> DataFrame:
    """``(user_id, item_id, score[, _seen])``: products of ratings and packed rows summed per user and column.

    ``seen`` marks the columns that the user rated (the matrix then holds its diagonal). With ``how='left'`` a
    rating without a matrix row gives a row with a null item, so that every user is present."""
    j = w.join(packed, F.col("item_id") == F.col("item_1"), how)
    explode = F.posexplode_outer if how == "left" else F.posexplode
    e = j.select("user_id", "item_id", "w", "vals", explode("cols").alias("_at", "_col"))
    return _sums(e, [], form, seen)


def _sums(e: DataFrame, keys: list[str], form: Narrow, seen: bool) -> DataFrame:
    """Scores of the products ``(*keys, user_id, item_id, w, vals, _at, _col)``."""
    aggs = [F.sum(F.col("w").cast("long") * F.get("vals", F.col("_at")).cast("long")).alias("score")]
    if seen:
        aggs.append(F.coalesce(F.max(form.item(F.col("_col")) == F.col("item_id")), F.lit(False)).alias("_seen"))
    s = e.groupBy(*keys, "user_id", "_col").agg(*aggs)
    return s.select("user_id", form.item(F.col("_col")).alias("item_id"), "score", *(["_seen"] if seen else []))


@dataclass
class Blocks:
    """The cells of a blocked product: user blocks, column blocks, and the users that are cut by item."""

    users: int
    columns: int
    products: int
    cut: DataFrame | None = None
    ratings: Narrow = Narrow()
    matrix: Narrow = Narrow()

    @property
    def cells(self) -> int:
        return self.users * self.columns


def _products_per_score(w: DataFrame, v: DataFrame, products: int, ratings: int) -> float:
    """How many products are summed to a score, counted over some users; it only sizes the cells."""
    share = min(1.0, SAMPLE_PRODUCTS / max(products, 1), SAMPLE_RATINGS / max(ratings, 1))
    some = w.filter(F.pmod(F.xxhash64("user_id", F.lit("plan")), F.lit(1 << 30)) < F.lit(math.ceil(share * (1 << 30))))
    if some.count() > 4 * SAMPLE_RATINGS:
        return 1.0
    sums = v.join(F.broadcast(some), F.col("item_1") == F.col("item_id")).groupBy("user_id", "item_2").agg(F.count("*").alias("n"))   # counted above
    got = sums.agg(F.sum("n").alias("products"), F.count("*").alias("scores")).first()
    return min(MAX_PRODUCTS_PER_SCORE, got["products"] / got["scores"]) if got["scores"] else 1.0


def plan_blocks(w: DataFrame, v: DataFrame, *, rows_per_task: int = SCORING_ROWS_PER_TASK, cells: int | None = None,
                max_hot_keys: int = DEFAULT_MAX_HOT_KEYS, kept: int = 0) -> Blocks:
    """Cells for ``w`` x ``v``, from the exact numbers of products per user and per column (small aggregates, one
    action) and, where these ask for more cells than the session has partitions, the products per score of some users.

    The number of cells follows from all scores, the blocks from the bytes of both sides and of the ``kept`` rows that
    a user sends on from each column block. The column with the most products stays within a quarter of a task in each
    user block, and users above ``USER_FILL`` are cut."""
    spark = w.sparkSession
    ranges = lambda item, val: [F.min(item).alias("_low"), F.max(item).alias("_high"), F.min(val).alias("_least"), F.max(val).alias("_most")]
    lengths = v.groupBy("item_1").agg(F.count("*").alias("_len"), *ranges("item_2", "val"))
    raters = w.groupBy("item_id").agg(F.count("*").alias("_raters"), F.min("w").alias("_least"), F.max("w").alias("_most"))
    per_user = w.join(lengths, F.col("item_id") == F.col("item_1")).groupBy("user_id").agg(
        F.sum("_len").alias("_products"), F.count("*").alias("_ratings"))
    per_column = v.join(raters, F.col("item_id") == F.col("item_1")).groupBy("item_2").agg(F.sum("_raters").alias("_products"))

    def whole(rows: DataFrame, item_type: DataType, low: str, high: str, *more: Column) -> DataFrame:
        low, high = (F.col(c) if isinstance(item_type, INTEGRAL) else F.lit(None) for c in (low, high))   # others have no range
        return rows.agg(F.min(low).cast("long").alias("low"), F.max(high).cast("long").alias("high"),
                        F.min("_least").cast("long").alias("least"), F.max("_most").cast("long").alias("most"), *more)
    types = w.schema["item_id"].dataType, v.schema["item_2"].dataType
    parts = [per_user.agg(F.sum("_products").alias("a"), F.sum("_ratings").alias("b"), F.max("_products").alias("c"), F.count("*").alias("d")),
             per_column.agg(F.max("_products").alias("c")),
             whole(lengths, types[1], "_low", "_high", F.sum("_len").alias("b")),
             whole(raters, types[0], "item_id", "item_id")]
    figures = parts[0]
    for p in parts[1:]:
        figures = figures.unionByName(p, allowMissingColumns=True)
    user, column, matrix, rated = figures.take(4)
    products, ratings, most, n_users, widest, entries = (int(x or 0) for x in (user["a"], user["b"], user["c"], user["d"], column["c"], matrix["b"]))
    forms = [narrow(kind, *(x[c] for c in ("low", "high", "least", "most"))) for kind, x in zip(types, (rated, matrix))]
    per_cell = max(1, int(rows_per_task * CELL_FILL))
    n = cells or max(default_partitions(spark), math.ceil(products / per_cell))
    if not cells and n > default_partitions(spark):
        n = max(default_partitions(spark), math.ceil(products / _products_per_score(w, v, products, ratings) / per_cell))
    by_column, by_user = ratings * sum(forms[0].widths) + n_users * kept * KEPT_ROW_BYTES, entries * sum(forms[1].widths)
    users = max(1, round(math.sqrt(n * max(by_column, 1) / max(by_user, 1))))
    users = max(min(users, n), math.ceil(4 * widest / rows_per_task))
    columns = max(1, math.ceil(n / users), math.ceil(by_user / CELL_MATRIX_BYTES))
    limit = max(1, int(rows_per_task * USER_FILL)) * columns
    cut = None
    if most > limit:
        heavy = per_user.filter(F.col("_products") > limit).select("user_id", F.ceil(F.col("_products") / limit).cast("int").alias("_parts"))
        heavy = heavy.filter("_parts > 1")
        cut = F.broadcast(heavy) if heavy.count() <= max_hot_keys else heavy
    return Blocks(users, columns, products, cut, *forms)


def _lists(df: DataFrame, keys: list[str], item: str, val: str, form: Narrow, names: tuple[str, str]) -> DataFrame:
    """``(*keys, *names)``: the items and values of each key as two arrays in item order, written once as they are copied
    from there. Lists are cut at ``SEGMENT_WIDTH`` ids."""
    segment = F.floor(F.col(item) / SEGMENT_WIDTH).alias("_segment")
    entry = F.struct(form.column(F.col(item)).alias("i"), form.value(F.col(val)).alias("x"))
    rows = df.groupBy(*keys, segment).agg(F.sort_array(F.collect_list(entry)).alias("_e"))
    return materialize(rows.select(*keys, F.col("_e.i").alias(names[0]), F.col("_e.x").alias(names[1])), names[0])


def _cells(w: DataFrame, entries: DataFrame, b: Blocks, how: str, seen: bool) -> DataFrame:
    part = ["_part"] if "_part" in w.columns else []
    lists = _lists(w, ["user_id", *part], "item_id", "w", b.ratings, ("items", "weights"))
    left = lists.withColumn("_u", F.pmod(F.xxhash64("user_id", *part), F.lit(b.users)).cast("int"))
    left = left.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(b.columns - 1))))
    left = left.select((F.col("_u") * b.columns + F.col("_j")).alias("_cell"), "user_id", "items", "weights").repartitionById(b.cells, F.col("_cell"))
    left = left.select("_cell", "user_id", "weights", F.posexplode("items").alias("_p", "_item"))
    left = left.select("_cell", "user_id", b.ratings.item(F.col("_item")).alias("item_id"), F.get("weights", F.col("_p")).alias("w"))
    right = entries.withColumn("_u", F.explode(F.sequence(F.lit(0), F.lit(b.users - 1))))
    right = right.select((F.col("_u") * b.columns + F.col("_j")).alias("_cell_at"), "item_1", "cols", "vals").repartitionById(b.cells, F.col("_cell_at"))
    # A hash join keeps a user's ratings together; its table holds at most about CELL_MATRIX_BYTES.
    j = left.join(right.hint("shuffle_hash"), (F.col("_cell") == F.col("_cell_at")) & (F.col("item_id") == F.col("item_1")), how)
    explode = F.posexplode_outer if how == "left" else F.posexplode
    e = j.select("_cell", "user_id", "item_id", "w", "vals", explode("cols").alias("_at", "_col"))
    # Grouped by the cell as well: the cells' own partitioning serves, nothing is shuffled again.
    return _sums(e, ["_cell"], b.matrix, seen)


def blocked_scores(w: DataFrame, v: DataFrame, b: Blocks, *, how: str = "inner", seen: bool = False) -> list[DataFrame]:
    """``(user_id, item_id, score[, _seen])`` of ``w`` ``(user_id, item_id, w)`` and ``v`` ``(item_1, item_2, val)``:
    the scores of ordinary users, complete in their cells, and of the users cut by item, summed over their cells."""
    w = w.select("user_id", "item_id", "w")
    dealt = v.withColumn("_j", F.pmod(F.xxhash64("item_2"), F.lit(b.columns)).cast("int"))
    entries = _lists(dealt, ["_j", "item_1"], "item_2", "val", b.matrix, ("cols", "vals"))
    if b.cut is None:
        return [_cells(w, entries, b, how, seen)]
    plain = w.join(b.cut, "user_id", "left_anti")
    cut = w.join(b.cut, "user_id").withColumn("_part", F.pmod(F.xxhash64("item_id"), F.col("_parts").cast("long"))).drop("_parts")
    parts = _cells(cut, entries, b, how, seen)
    aggs = [F.sum("score").alias("score"), *([F.max("_seen").alias("_seen")] if seen else [])]
    return [_cells(plain, entries, b, how, seen), parts.groupBy("user_id", "item_id").agg(*aggs)]
