"""Co-rating self-join, pair statistics and cosine similarity between items."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, ShortType

from corate.functions.scalars import cosine
from corate.operators.catalog import ratings_in_catalog
from corate.operators.dedupe import latest_by_key
from corate.plans.skew import (
    DEFAULT_MAX_BROADCAST_BYTES,
    DEFAULT_MAX_HOT_KEYS,
    chunk_of,
    partitions_for,
    split_hot_keys,
)
from corate.session import materialize

# A user with more ratings than this is cut into chunks of about this many items before the
# self-join, so one task holds at most ~threshold^2 / 2 item pairs of a single user.
DEFAULT_HOT_USER_DEGREE = 2000

def checked_rating(col: str = "rating") -> Column:
    """The rating, or an error for a negative one (no extra pass): truncated products are only defined for
    non-negative ratings, as truncating a running sum of negative terms depends on their order."""
    return F.when(F.col(col).isNull() | (F.col(col) >= 0), F.col(col)).otherwise(
        F.raise_error(F.lit("truncated products need non-negative ratings")))


CO_RATING_COLUMNS = ["user_id", "item_1", "item_2", "rating_1", "rating_2"]


def _pairs_by_user(r: DataFrame, partitions: int | None = None) -> DataFrame:
    """Equi-join on ``user_id`` with ``item_1 < item_2`` as the join residual (upper triangle).

    With ``partitions``, the ratings are hash partitioned on the user once, explicitly, and both
    join sides reuse that exchange; the count is sized by the pair volume, which AQE cannot see
    from the shuffled rating rows.
    """
    if partitions:
        r = r.repartition(partitions, "user_id")
    a = r.select("user_id", F.col("item_id").alias("item_1"), F.col("rating").alias("rating_1"))
    b = r.select("user_id", F.col("item_id").alias("item_2"), F.col("rating").alias("rating_2"))
    return a.join(b, "user_id").where(F.col("item_1") < F.col("item_2")).select(*CO_RATING_COLUMNS)


def _pairs_by_user_chunk(heavy: DataFrame, partitions: int) -> DataFrame:
    """Co-ratings of hot users, spread over ``(user, chunk_a, chunk_b)`` cells.

    Each rating goes to chunk ``c = hash(item) mod n_chunks``. The left copy of a rating in chunk
    ``c`` is sent to the cells ``(c, b)`` for ``b >= c``, the right copy to ``(a, c)`` for
    ``a <= c``; so cell ``(a, b)`` pairs chunk ``a`` with chunk ``b`` and every unordered item pair
    meets in exactly one cell. Diagonal cells keep ``left < right``; off-diagonal pairs are put in
    ascending item order. Both sides are partitioned on the cell explicitly, with a count sized
    by the pair volume: the replicated rating rows are few bytes, and AQE would otherwise
    coalesce the cells of a hot user back into a few tasks.
    """
    c = chunk_of("item_id")
    last = F.col("n_chunks") - 1
    left = heavy.select(
        "user_id", F.col("item_id").alias("i_l"), F.col("rating").alias("r_l"),
        c.alias("a"), F.explode(F.sequence(c, last)).alias("b"))
    right = heavy.select(
        "user_id", F.col("item_id").alias("i_r"), F.col("rating").alias("r_r"),
        c.alias("b"), F.explode(F.sequence(F.lit(0), c)).alias("a"))
    cell = ["user_id", "a", "b"]
    left, right = left.repartition(partitions, *cell), right.repartition(partitions, *cell)
    j = left.join(right, cell).where(
        (F.col("a") < F.col("b")) | (F.col("i_l") < F.col("i_r")))
    swap = F.col("i_l") > F.col("i_r")
    return j.select(
        "user_id",
        F.least("i_l", "i_r").alias("item_1"),
        F.greatest("i_l", "i_r").alias("item_2"),
        F.when(swap, F.col("r_r")).otherwise(F.col("r_l")).alias("rating_1"),
        F.when(swap, F.col("r_l")).otherwise(F.col("r_r")).alias("rating_2"),
    )


def co_ratings(ratings: DataFrame, items: DataFrame | None = None, *,
               hot_user_degree: int | None = DEFAULT_HOT_USER_DEGREE,
               max_hot_users: int = DEFAULT_MAX_HOT_KEYS, user_partitioned: bool = False) -> DataFrame:
    """For every user and every pair of items they both rated: ``(user_id, item_1, item_2,
    rating_1, rating_2)`` with ``item_1 < item_2``.

    ``items`` restricts both sides to a catalog first (semi join). Users with more than
    ``hot_user_degree`` ratings are joined on ``(user, chunk pair)`` cells instead of on the user
    alone (see ``split_hot_keys``); ``None`` turns the split off and leaves skew to AQE.
    ``user_partitioned=True`` declares that ``ratings`` is already hash partitioned by user (a
    table bucketed by ``user_id``): it is not repartitioned, and the self join reads the buckets.
    """
    r = ratings.select("user_id", "item_id", "rating")
    if items is not None:
        r = ratings_in_catalog(r, items)
    if hot_user_degree is None:
        return _pairs_by_user(r)
    split = split_hot_keys(r, "user_id", min_degree=hot_user_degree, max_hot_keys=max_hot_users)
    parts = partitions_for(r.sparkSession, split.square_sum // 2)
    # Bucketed input keeps its own partitioning; otherwise partition once, sized by the pair volume.
    by_user = None if user_partitioned else parts
    if split.hot is None:
        return _pairs_by_user(r, by_user)
    return _pairs_by_user(split.normal, by_user).unionByName(_pairs_by_user_chunk(split.hot, parts))


def pair_stats(co: DataFrame, truncate: bool = True) -> DataFrame:
    """Per item pair: co-rater count ``n``, dot product ``num`` and squared norms ``d1``, ``d2``
    over the common raters only.

    ``truncate=True`` floors every product before summing (the integer accumulators of the
    original job) and gives bigint sums; a negative rating is an error. ``False`` sums the
    exact double products. All four are algebraic, so Spark aggregates partially before the
    shuffle on the pair.
    """
    if truncate:
        def prod(x, y):
            return F.floor(checked_rating(x) * checked_rating(y))
    else:
        def prod(x, y):
            return F.col(x) * F.col(y)
    return co.groupBy("item_1", "item_2").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(prod("rating_1", "rating_2")).alias("num"),
        F.sum(prod("rating_1", "rating_1")).alias("d1"),
        F.sum(prod("rating_2", "rating_2")).alias("d2"),
    )


# Entries of stripes that one task of users makes (32 MB as codes); an item with more of them is paired in rows instead.
STRIPE_ENTRIES = 8_000_000
# Entries of stripes that one task pairs up: each may be a pair of its own, held twice at some 130 bytes (by Spark's
# partial and its final aggregate).
SUM_ENTRIES = 2_000_000


# Greatest number of half stars that a code holds.
MAX_HALF_STARS = 253


@dataclass
class Codes:
    """An item and its rating in half stars as one int, in item order: a quarter of the bytes of a bigint and a double.
    ``split``: all codes are below 2^24, and a list of them travels as shorts with a list of their upper bytes."""

    low: int
    bits: int
    item_type: DataType
    rating_type: DataType
    split: bool = False

    def encoded(self, r: DataFrame) -> DataFrame:
        """``r`` with codes for items and without ratings."""
        stars = F.coalesce((F.col("rating") * 2).cast("long") + 1, F.lit(0))   # 0: no rating
        code = F.shiftleft(F.col("item_id").cast("long") - self.low, self.bits) + stars
        return r.withColumn("item_id", code.cast("int")).drop("rating")

    def item(self, code: Column) -> Column:
        return (F.shiftright(code, self.bits) + F.lit(self.low).cast("long")).cast(self.item_type)

    def lists(self, codes: Column) -> dict[str, Column]:
        """A list of codes as the columns that travel."""
        if not self.split:
            return {"_items": codes}
        return {"_items": F.transform(codes, lambda c: (c.bitwiseAND(F.lit(0xFFFF)) - 0x8000).cast("short")),
                "_upper": F.transform(codes, lambda c: (F.shiftright(c, 16) - 0x80).cast("byte"))}

    def exploded(self, s: DataFrame, *kept: str) -> DataFrame:
        """``(*kept, _c)`` with a row for every code of a list."""
        if not self.split:
            return s.select(*kept, F.explode("_items").alias("_c"))
        e = s.select(*kept, "_upper", F.posexplode("_items").alias("_p", "_lower"))
        upper = F.get("_upper", F.col("_p")).cast("int") + 0x80
        return e.select(*kept, (F.shiftleft(upper, 16) + F.col("_lower").cast("int") + 0x8000).alias("_c"))

    def rating(self, code: Column) -> Column:
        stars = code.bitwiseAND(F.lit((1 << self.bits) - 1))
        return F.when(stars > 0, ((stars - 1) / 2).cast(self.rating_type))


def _figures(r: DataFrame, hot_user_degree: int) -> tuple[tuple[int, int], int, Codes | None]:
    """``(sum of squared degrees, hot users)``, the largest degree, and codes if all items and ratings of ``r`` have
    one; in one job over one row per user and one of the whole."""
    kinds = r.schema["item_id"].dataType, r.schema["rating"].dataType
    able = isinstance(kinds[0], (ByteType, ShortType, IntegerType, LongType)) and isinstance(kinds[1], (DoubleType, FloatType))
    # The whole's figures apart from the users': their rows are shuffled with a count only.
    users = r.groupBy("user_id").agg(F.count("*").alias("_deg")).agg(
        F.sum(F.col("_deg") * F.col("_deg")).alias("a"), F.count(F.when(F.col("_deg") > hot_user_degree, True)).alias("b"), F.max("_deg").alias("c"))
    names, none = ["low", "high", "most"], F.lit(None).cast("long")
    if able:
        twice = F.col("rating") * 2
        half = twice.between(0, MAX_HALF_STARS) & (F.floor(twice) == twice)
        whole = r.agg(F.min("item_id").cast("long").alias("low"), F.max("item_id").cast("long").alias("high"),
                      F.when(F.bool_and(half), F.coalesce(F.max(twice), F.lit(0)).cast("long")).alias("most"))
        users = users.select("*", *[none.alias(n) for n in names]).unionByName(whole.select(*[none.alias(n) for n in "abc"], *names))
        users = users.agg(*[F.max(n).alias(n) for n in ("a", "b", "c", *names)])
    got = users.first()
    codes = None
    if able and got["low"] is not None and got["most"] is not None:
        bits = (got["most"] + 1).bit_length()
        span = (got["high"] - got["low"] + 1) << bits
        if span <= (1 << 31) - 1:
            codes = Codes(got["low"], bits, *kinds, split=span <= 1 << 24)
    return (got["a"] or 0, got["b"] or 0), got["c"] or 0, codes


def _stripe(own: Column, rest: Column, signed: Sequence[str], codes: Codes | None) -> list[Column]:
    if codes:
        return [*_own(own, signed, codes), *[x.alias(c) for c, x in codes.lists(rest["item_id"]).items()]]
    return [*[F.col(c) for c in signed], own["item_id"].alias("item_1"), own["rating"].alias("rating_1"),
            rest["item_id"].alias("_items"), rest["rating"].alias("_ratings")]


def _own(own: Column, signed: Sequence[str], codes: Codes) -> list[Column]:
    return [*[F.col(c) for c in signed], codes.item(own["item_id"]).alias("item_1"), codes.rating(own["item_id"]).alias("rating_1")]


def _entry(r: DataFrame) -> Column:
    return F.struct(*[c for c in ("item_id", "rating", "_changed") if c in r.columns])


def _stripes_by_user(r: DataFrame, signed: Sequence[str] = (), codes: Codes | None = None) -> DataFrame:
    """A user's ratings in item order, and for each of them those that follow: ``(*signed, item_1, rating_1, _items,
    _ratings)``, or ``codes.lists`` instead of the last two. With a column ``_changed``, only pairs with a changed rating."""
    lists = r.groupBy("user_id", *signed).agg(F.sort_array(F.collect_list(_entry(r))).alias("_l"))
    if "_changed" in r.columns:
        return _changed_stripes(lists, signed, codes)
    if codes:
        packed = codes.lists(F.col("_l.item_id"))
        lists = lists.select(*signed, "_l", *[x.alias(c) for c, x in packed.items()])   # once per user, then cut
        one = lists.select(*signed, *packed, F.posexplode("_l").alias("_p", "_e")).filter(F.col("_p") < F.size("_items") - 1)
        return one.select(*_own(F.col("_e"), signed, codes), *[F.slice(c, F.col("_p") + 2, F.size(c)).alias(c) for c in packed])
    one = lists.select(*signed, "_l", F.posexplode("_l").alias("_p", "_e")).filter(F.col("_p") < F.size("_l") - 1)
    rest = F.slice("_l", F.col("_p") + 2, F.size("_l"))
    return one.select(*signed, "_e", rest.alias("_rest")).select(*_stripe(F.col("_e"), F.col("_rest"), signed, codes))


def _changed_stripes(lists: DataFrame, signed: Sequence[str], codes: Codes | None) -> DataFrame:
    """The stripes of pairs with a changed rating: a changed one is followed by all later ones, another by the later
    changed ones. The list is cut before each changed rating, so both are slices of lists made once per user."""
    def travelling(entries: str) -> dict[str, Column]:
        return codes.lists(F.col(f"{entries}.item_id")) if codes else {"_items": F.col(f"{entries}.item_id"), "_ratings": F.col(f"{entries}.rating")}

    at = F.array_compact(F.transform("_l", lambda x, i: F.when(x["_changed"], i)))
    lists = lists.withColumn("_at", at).filter(F.size("_at") > 0).withColumn("_c", F.filter("_l", lambda x: x["_changed"]))
    every, few = travelling("_l"), travelling("_c")
    lists = lists.select(*signed, "_l", "_at", *[x.alias(c) for c, x in every.items()], *[x.alias("_few" + c) for c, x in few.items()])
    before = F.when(F.col("_j") > 0, F.get("_at", F.col("_j") - 1)).otherwise(-1)
    cut = lists.select("*", F.posexplode("_at").alias("_j", "_p")).withColumn("_before", before)
    kept = [*signed, *every, *["_few" + c for c in few], "_j", "_p"]
    one = cut.select(*kept, F.explode(F.slice("_l", F.col("_before") + 2, F.col("_p") - F.col("_before"))).alias("_e"))
    rest = [F.when(F.col("_e._changed"), F.slice(c, F.col("_p") + 2, F.size(c))).otherwise(
        F.slice("_few" + c, F.col("_j") + 1, F.size("_few" + c))).alias(c) for c in every]
    own = _own(F.col("_e"), signed, codes) if codes else [*[F.col(c) for c in signed], F.col("_e.item_id").alias("item_1"), F.col("_e.rating").alias("rating_1")]
    return one.select(*own, *rest).filter(F.size("_items") > 0)


def _stripes_by_user_chunk(heavy: DataFrame, partitions: int, signed: Sequence[str] = (), codes: Codes | None = None) -> DataFrame:
    """The same of hot users, by ``(user, chunk_a, chunk_b)`` cells: each rating of chunk ``a`` meets the list of chunk
    ``b`` and keeps its greater items."""
    c, every = chunk_of("item_id"), F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1))
    cell = ["user_id", *signed, "a", "b"]
    left = heavy.select("user_id", *signed, _entry(heavy).alias("_e"), c.alias("a"), every.alias("b"))
    right = heavy.withColumn("b", c).groupBy("user_id", *signed, "b", "n_chunks").agg(F.collect_list(_entry(heavy)).alias("_l"))
    right = right.select("user_id", *signed, "b", "_l", every.alias("a"))
    j = left.repartition(partitions, *cell).join(right.repartition(partitions, *cell), cell)
    fit = F.filter("_l", lambda x: x["item_id"] > F.col("_e.item_id"))
    if "_changed" in heavy.columns:
        fit = F.filter("_l", lambda x: (x["item_id"] > F.col("_e.item_id")) & (F.col("_e._changed") | x["_changed"]))
    one = j.select(*signed, "_e", fit.alias("_rest")).filter(F.size("_rest") > 0)
    return one.select(*_stripe(F.col("_e"), F.col("_rest"), signed, codes))


def sum_tasks(ratings: DataFrame) -> int:
    """Tasks that the sums of the co-ratings of ``ratings`` are dealt over, from one row per user."""
    degrees = ratings.groupBy("user_id").agg(F.count("*").alias("_deg"))
    squares = degrees.agg(F.sum(F.col("_deg") * F.col("_deg")).alias("n")).first()["n"] or 0
    return partitions_for(ratings.sparkSession, squares // 2, SUM_ENTRIES)


def pairs_by_item(r: DataFrame, signed: Sequence[str] = (), *, hot_user_degree: int = DEFAULT_HOT_USER_DEGREE,
                  max_hot_users: int = DEFAULT_MAX_HOT_KEYS, user_partitioned: bool = False, entries: int = STRIPE_ENTRIES,
                  arranged: Callable[[DataFrame], DataFrame] | None = None, sums: int | None = None) -> list[DataFrame]:
    """The co-ratings ``(*signed, item_1, item_2, rating_1, rating_2)`` for a sum per pair, without pairs common to
    two of the frames.

    Few of a pair's co-ratings meet in a task that holds some users, so their partial sums would be shuffled almost
    one by one. Instead each rating goes to its item's task with the array of its user's later ratings (3 or 4 bytes
    per co-rating before compression where ``Codes`` fit, else 16, and no keys), and all co-ratings of a pair meet there: a sum on the pair needs
    no further exchange. Items with more than ``entries`` co-ratings come as rows in a frame of their own, whose sums
    combine before the exchange, as such an item has many co-ratings of each pair.

    ``arranged`` makes the rows with ``signed`` (and ``_changed``) of the rows of ``r``, from those of one user and item at
    a time and where they lie, so that what it makes of a row is not shuffled; it keeps columns that it does not know.
    ``sums`` fixes the hash partitions of ``item_1`` that the co-ratings come in (else ``sum_tasks``)."""
    r = r.filter("user_id is not null and item_id is not null")
    known, ratings, codes = _figures(r, hot_user_degree)
    coded = codes.encoded if codes else lambda x: x
    split = split_hot_keys(r if arranged else coded(r), "user_id", min_degree=hot_user_degree, max_hot_keys=max_hot_users, known=known)
    parts = partitions_for(r.sparkSession, split.square_sum // 2, entries)
    sums = sums or partitions_for(r.sparkSession, split.square_sum // 2, min(entries, SUM_ENTRIES))
    normal, heavy = split.normal, split.hot
    if not user_partitioned:
        normal = normal.repartition(parts, "user_id")
    if arranged:
        normal, heavy = coded(arranged(normal)), heavy if heavy is None else coded(arranged(heavy))
    stripes = _stripes_by_user(normal, signed, codes)
    if heavy is not None:
        stripes = stripes.unionByName(_stripes_by_user_chunk(heavy, parts, signed, codes))
    n_hot = 0
    if split.square_sum // 2 > entries:   # else no item can have more
        raters = r.groupBy("item_id").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
        if ratings * raters > entries:
            hot = stripes.groupBy("item_1").agg(F.sum(F.size("_items")).alias("_n")).filter(F.col("_n") > entries).select("item_1")
            n_hot = hot.count()
    dealt = stripes
    if n_hot:
        hot = F.broadcast(hot)   # at most one item per `entries` co-ratings
        dealt = stripes.join(hot, "item_1", "left_anti")
    # In item order, so that the sums of an item's pairs are near each other in the hash table.
    found = [dealt.repartition(sums, "item_1").sortWithinPartitions("item_1")]
    if n_hot:
        found = [*found, stripes.join(hot, "item_1", "left_semi")]

    def rows(s: DataFrame) -> DataFrame:
        if codes:
            e = codes.exploded(s, *signed, "item_1", "rating_1")
            e = e.select(*signed, "item_1", codes.item(F.col("_c")).alias("item_2"), "rating_1", codes.rating(F.col("_c")).alias("rating_2"))
            return e.filter("item_1 < item_2")
        e = s.select(*signed, "item_1", "rating_1", "_ratings", F.posexplode("_items").alias("_p", "item_2"))
        return e.filter("item_1 < item_2").select(*signed, "item_1", "item_2", "rating_1", F.get("_ratings", F.col("_p")).alias("rating_2"))
    return [rows(s) for s in found]


def rating_pair_stats(ratings: DataFrame, items: DataFrame | None = None, *, truncate: bool = True, **kw) -> DataFrame:
    """``pair_stats`` of the co-ratings of ``ratings``, summed at the items (``pairs_by_item``, which takes ``kw``)."""
    r = ratings.select("user_id", "item_id", "rating")
    if items is not None:
        r = ratings_in_catalog(r, items)
    return reduce(DataFrame.unionByName, [pair_stats(p, truncate) for p in pairs_by_item(r, **kw)])


def frequent_pairs(stats: DataFrame, min_support: int = 20) -> DataFrame:
    """Pairs with at least ``min_support`` co-raters: ``(item_1, item_2, n)``."""
    return stats.filter(F.col("n") >= min_support).select("item_1", "item_2", "n")


def similarity_from_stats(stats: DataFrame, truncate: bool = True) -> DataFrame:
    """``(item_1, item_2, similarity, n_ratings)`` from pair statistics.

    Truncated mode keeps the IEEE results of a zero denominator (NaN or +infinity); exact mode
    drops such pairs.
    """
    sim = cosine("num", "d1", "d2", parity=truncate).alias("similarity")
    out = stats.select("item_1", "item_2", sim, F.col("n").alias("n_ratings"))
    if not truncate:
        out = out.filter(F.col("similarity").isNotNull())
    return out


# A broadcast item-id set costs ~16 bytes per id.
ITEM_SET_ROW_BYTES = 16


def rated_at_least(ratings: DataFrame, min_raters: int, *,
                   max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Ratings of items with at least ``min_raters`` raters.

    A pair can only have ``n`` common raters if both items have ``n`` raters, so this is an exact
    pre-filter for any support threshold, applied before the quadratic self join. One job counts
    the frequent and the rare items (item counts combine map-side). The smaller set is then
    broadcast: a semi join with the frequent items, or an anti join with the rare ones. Both keep
    the ratings' partitioning. Nothing rare: no join. Both sets too large to broadcast: a shuffled
    semi join with the frequent items; the rows are the same at every size.
    """
    counts = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("_raters"))
    stats = counts.agg(F.count(F.when(F.col("_raters") >= min_raters, True)).alias("frequent"),
                       F.count(F.when(F.col("_raters") < min_raters, True)).alias("rare")).first()
    frequent, rare = stats["frequent"] or 0, stats["rare"] or 0
    if rare == 0:
        return ratings
    if min(frequent, rare) * ITEM_SET_ROW_BYTES > max_broadcast_bytes:
        keep = counts.filter(F.col("_raters") >= min_raters).select("item_id")
        return ratings.join(keep, "item_id", "left_semi")
    if frequent <= rare:
        keep = counts.filter(F.col("_raters") >= min_raters).select("item_id")
        return ratings.join(F.broadcast(keep), "item_id", "left_semi")   # `frequent` ids, counted
    drop = counts.filter(F.col("_raters") < min_raters).select("item_id")
    return ratings.join(F.broadcast(drop), "item_id", "left_anti")       # `rare` ids, counted


def unique_ratings(ratings: DataFrame, partitions: int | None = None) -> DataFrame:
    """One ``(user_id, item_id, rating)`` per user and item: the newest by ``ts`` where the frame has that column,
    then the greatest rating. With ``partitions`` the rows are dealt by user first, which a self join on the user
    uses again."""
    r = ratings.repartition(partitions, "user_id") if partitions else ratings
    if "ts" in ratings.columns:
        return latest_by_key(r, ["user_id", "item_id"], ["ts", "rating"], values=["rating"])
    return r.groupBy("user_id", "item_id").agg(F.max("rating").alias("rating"))


def item_similarity(ratings: DataFrame, items: DataFrame | None = None, *, min_support: int = 20,
                    truncate: bool = True, hot_user_degree: int | None = DEFAULT_HOT_USER_DEGREE,
                    max_hot_users: int = DEFAULT_MAX_HOT_KEYS, user_partitioned: bool = False,
                    prune_rare_items: bool = True, unique: bool = False) -> DataFrame:
    """Cosine similarity of every item pair with at least ``min_support`` common raters.

    A user's rating of an item counts once, also where a log lists it several times: the newest by
    ``ts`` if the frame has that column, then the greatest (``unique_ratings``). ``unique=True`` declares that the
    table holds one row per user and item, as tables written by ``load_job`` do, and saves that step.

    Plan: (one row per user and item) -> (catalog semi join) -> (drop items with fewer than ``min_support``
    raters) -> each rating with its user's later ones to its item's task (hot users chunked, ``pairs_by_item``) ->
    sums per pair there -> support filter -> cosine. ``hot_user_degree=None``: self join on user -> partial
    aggregate -> shuffle on the pair -> final aggregate, which suits few items with very many raters.
    """
    if not unique:
        ratings = materialize(unique_ratings(ratings), "unique_ratings")   # read several times below
    r = ratings.select("user_id", "item_id", "rating")
    if truncate:
        r = r.withColumn("rating", checked_rating())
    if items is not None:
        r = ratings_in_catalog(r, items)
    if prune_rare_items and min_support > 1:
        r = rated_at_least(r, min_support)
    if hot_user_degree is None:
        stats = pair_stats(co_ratings(r, hot_user_degree=None), truncate=truncate)
    else:
        stats = rating_pair_stats(r, truncate=truncate, hot_user_degree=hot_user_degree, max_hot_users=max_hot_users,
                                  user_partitioned=user_partitioned)
    return similarity_from_stats(stats.filter(F.col("n") >= min_support), truncate=truncate)


def candidate_pairs(ratings: DataFrame, items: DataFrame | None = None, **kw) -> DataFrame:
    """Item pairs that share at least one rater: ``(item_1, item_2)``.

    The original job tests every pair of catalog items and emits only pairs with a common
    rater; this produces the same pair set from the co-rating join without enumerating the
    catalog cross product.
    """
    return rating_pair_stats(ratings, items, **kw).select("item_1", "item_2")
