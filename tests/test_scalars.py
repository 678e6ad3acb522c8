"""Scalar helpers: title marker, title year, half-star weights, cosine guard."""

import math

from pyspark.sql import functions as F

from corate.functions import cosine, half_star_weight, title_has_marker, title_year


def test_title_marker_and_year(spark):
    titles = ["American President, The (2005)", "20 Leagues (20,000) (1954)", "Old One (1995)", "(2001)x", None]
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    got = [(r.m, r.y) for r in df.select(title_has_marker("title").alias("m"), title_year("title").alias("y")).collect()]
    assert got == [(True, 2005), (True, 1954), (False, 1995), (True, 2001), (None, None)]


def test_half_star_weights(spark):
    df = spark.createDataFrame([(x / 2,) for x in range(0, 11)] + [(2.3,), (None,)], "r double")
    got = [r[0] for r in df.select(half_star_weight("r")).collect()]
    assert got == list(range(0, 11)) + [4, None]


def test_cosine_guard(spark):
    df = spark.createDataFrame([(27, 41, 31), (2, 25, 0), (0, 0, 0)], "num bigint, d1 bigint, d2 bigint")
    parity = [r[0] for r in df.select(cosine("num", "d1", "d2")).collect()]
    assert parity[0] == 27 / (math.sqrt(41) * math.sqrt(31)) and parity[1] == math.inf and math.isnan(parity[2])
    exact = [r[0] for r in df.select(cosine("num", "d1", "d2", parity=False)).collect()]
    assert exact[1:] == [None, None]
