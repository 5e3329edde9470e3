"""Connected components of a table of links, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from . import common
from .common import cut, drop, join_parts


def _pairs(links: DataFrame, *ways: tuple[str, str]) -> DataFrame:
    """(a, b): each row of links in these ways, where it is."""
    return links.select(F.explode(F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in ways])).alias("l")).select("l.*")


def _least(both: DataFrame) -> DataFrame:
    """For each node a of (a, b): the least of itself and its neighbours, and how many links it has."""
    return both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"), F.count("*").alias("n"))


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of links (a, b), as a written table: label is the least node that it is connected with.

    Each round hangs the larger neighbours of a node, then the smaller ones, on
    the least node known; it ends when the links no longer change. A node with
    very many links is pre-aggregated before the shuffle, its links are dealt to
    several tasks, and no list of neighbours is gathered. FEW_ROWS links and fewer
    are one partition, whose rounds need no shuffle. Links of a node to
    itself and links with a null say nothing.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen, total = None, edges.count()
    while True:
        held = edges.coalesce(1) if total <= common.FEW_ROWS else edges
        both = _pairs(held, ("a", "b"), ("b", "a"))
        large = join_parts(both, _least(both), ["a"], 2 * total).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = join_parts(large, least, ["a"], 2 * total)
        told = Observation()
        small = _pairs(small, ("b", "m"), ("a", "m")).where("a <> b").distinct().observe(told, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"))
        before, edges = edges, cut(small, "links")
        drop(before)
        state = told.get["n"], told.get["sum"]
        if state == seen:
            break
        seen, total = state, state[0]
    out = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    out = cut(out.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()), "labels")
    drop(edges)
    return out
