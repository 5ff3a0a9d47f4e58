"""Connected components as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.llm.common import dropped, saved


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``edges`` with columns a and b.

    Large star and small star in turn: each node's larger neighbours, then its smaller ones, are hung on its smallest.
    Minima are map-side aggregates and neighbours are never collected, so a node with very many links costs what its
    links cost. Each round is a checkpoint; the rounds end when the links are stars: every larger end has one link only
    and is no smaller end.
    """
    links = saved(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _stars(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.expr("case when v = m then array(struct(u as u, m as v)) else array(struct(u as u, m as v), struct(v as u, m as v)) end")).alias("e")).select("e.u", "e.v").distinct()
        links, before = saved(small), links
        dropped(before)
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _stars(links: DataFrame) -> bool:
    ends = links.select(F.explode(F.expr("array(struct(u as node, 1 as up, 0 as down), struct(v as node, 0 as up, 1 as down))")).alias("e")).select("e.*")
    counted = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counted.where("up > 1 or up = 1 and down = 1").isEmpty()
