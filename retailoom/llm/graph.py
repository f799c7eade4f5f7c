"""Connected components by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailoom.llm.store import Scratch


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Hang neighbours on the smallest node around. Small: only smaller neighbours and the node itself."""
    if small:
        ways = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        ways = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = ways.join(least, "u")
    if small:
        kept = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    else:
        kept = moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return kept.where("a <> b").distinct()


def _digest(edges: DataFrame) -> tuple:
    """Tells whether a step changed anything; edges run from the larger node to the smaller one."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def joined_components(groups: DataFrame | None, links: DataFrame, earlier: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Components after some more links: only these are worked on, between the components there were.

    ``groups`` is what ``components`` gave for the links ``earlier``; None if it was not asked yet.
    """
    if groups is None:
        return components(earlier.unionByName(links), scratch, name)
    of = groups.select("id", "component")
    ends = links.join(of.toDF("a", "ca"), "a", "left").join(of.toDF("b", "cb"), "b", "left")
    between = ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    joined = components(between, scratch, f"{name}-joined")
    moved = groups.join(joined.toDF("component", "now"), "component", "left").select("id", F.coalesce("now", "component").alias("component"))
    new = joined.join(groups.select("id"), "id", "left_anti")  # nodes that had no link before
    return scratch.settle(moved.unionByName(new), name)


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(id, component) of every node with an edge; component is the smallest node reachable.

    ``edges`` has two long columns a and b. A node with very many edges is a long list of rows, never one group: per
    node only a minimum is taken. Each step is stored, so the plan stays short. Nodes without edges don't appear.
    """
    edges = scratch.settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = _digest(edges)
    while before[0]:
        edges = scratch.settle(_stars(_stars(edges, small=False), small=True), name)
        now = _digest(edges)
        if now == before:
            break
        before = now
    leaves = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return leaves.unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
