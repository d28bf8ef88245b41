"""Connected components of links between ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctmart.llm.common import cut
from acctmart.operators.joins import attach_spread


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id that two-column ``links`` name; component is the smallest id reachable.

    Each round connects the larger neighbours of every id to its smallest neighbour, then the smaller
    ones. Rounds are as many as the logarithm of the longest path; each is two sums and two joins
    whose rows are two ids, and its edges are written to the checkpoint folder. No id's
    neighbours are ever gathered: a hub is a key of a join whose sides are both shuffled for it
    alone, the form in which adaptive execution splits a hub's rows.
    """
    a, b = links.columns
    edges = cut(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    )
    mark = _mark(edges)
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            attach_spread(both, least, "u", "inner").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            attach_spread(large, least, "u", "inner")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges, before = cut(small), mark
        mark = _mark(edges)
        if mark == before:
            break
    leaves = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return leaves.union(leaves.select("component", "component").distinct())
