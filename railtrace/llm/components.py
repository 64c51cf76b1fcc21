"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtrace.llm.common import discard, written

MAX_ROUNDS = 60  # a few suffice: the number grows with the logarithm of the longest path


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (u, v: long): the smallest node it reaches.

    Each round writes its edges to the shared folder and deletes the last round's.  Minima are aggregated
    before the shuffle and joined back, so a node with very many edges is not
    gathered anywhere; AQE splits its rows in the join.
    """
    pairs = edges.where("u <> v")
    stars = written(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars")
    mark = _mark(stars)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, stars = stars, written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        discard(old)
        last, mark = mark, _mark(stars)
        if mark == last:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(stars: DataFrame) -> tuple:
    row = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]
