"""Connected components of links by alternating large and small stars, each round written out."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate.llm.common import drop_stage, small_broadcast, write_stage

HELD = 1 << 17      # nodes that a task joins up at once before it writes their forest
ROW_BYTES = 96      # two texts' digests and their headers


def _forest(batches):
    """Per task, the links given joined up: every node but the smallest of its part, with that smallest. The
    components of all tasks' rows are those of all links; paths within a task are one link long."""
    up: dict = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def rows():
        held = [(x, root(x)) for x in list(up)]
        return pd.DataFrame([(x, r) for x, r in held if x != r], columns=["a", "b"])

    for pdf in batches:
        for a, b in zip(pdf["a"], pdf["b"], strict=True):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
        if len(up) > HELD:
            yield rows()
            up = {}
    if up:
        yield rows()


def _joined_up(links: DataFrame, name: str) -> DataFrame:
    kind = links.schema["a"].dataType.simpleString()
    return write_stage(links.select("a", "b").mapInPandas(_forest, f"a {kind}, b {kind}"), name)


def _ends(edges: DataFrame) -> DataFrame:
    """Per node the smallest and the largest that it points to, and whether any points to it."""
    ends = edges.select(F.col("a").alias("n"), F.col("b").alias("to"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("b").alias("n"), F.lit(None).cast(edges.schema["b"].dataType).alias("to"), F.lit(1).alias("into")))
    return write_stage(ends.groupBy("n").agg(F.min("to").alias("low"), F.max("to").alias("high"), F.max("into").alias("into")), "ends")


def components(links: DataFrame) -> DataFrame:
    """``(a, b)``: every linked node but the smallest of its component, with that smallest node.

    Links within a task are joined up before each round. Large star: neighbours above a node are linked to its
    smallest neighbour; small star: those below it are. Both are a minimum per node (combined before the shuffle) and
    a join, by broadcast if the counted nodes are few and else one that adaptive execution can split, so a node with
    very many links is no group of one task. The minimum of the large star also tells whether the last
    round ended it. The number of rounds grows with the logarithm of the longest path."""
    edges = _joined_up(links, "links")
    while True:
        ends = _ends(edges)
        if not ends.filter("low <> high or (low is not null and into = 1)").take(1):
            drop_stage(edges)
            return ends.filter("low is not null").select(F.col("n").alias("a"), F.col("low").alias("b"))
        few = ends.count()
        low = ends.select(F.col("n").alias("b"), F.coalesce("low", "n").alias("m"))
        large = edges.join(small_broadcast(low, few, ROW_BYTES), "b").select("a", F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        j = large.join(small_broadcast(low, few, ROW_BYTES), "a")
        small = j.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            j.select("a", F.col("m").alias("b")))
        nxt = _joined_up(small, "stars")
        drop_stage(edges)
        drop_stage(ends)
        edges = nxt


def merged(comp: DataFrame, between: DataFrame) -> DataFrame:
    """Components ``comp`` after ``between``, the components of links among their smallest nodes (and
    nodes of none): members of a linked component move to its new smallest node. One join instead of
    further rounds over the members."""
    move = between.select(F.col("a").alias("b"), F.col("b").alias("_to"))
    moved = comp.join(small_broadcast(move, between.count(), ROW_BYTES), "b", "left").select("a", F.coalesce("_to", "b").alias("b"))
    return write_stage(moved.unionByName(between.select("a", "b")), "components")
