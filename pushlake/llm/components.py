"""Connected components of an edge table by alternating large-star and small-star
steps: every step is a grouped minimum with map-side combine and a join, each vertex
moves to the smallest id it sees, and the number of rounds is logarithmic in
practice. Rounds are written to the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pushlake.llm._util import measured


def _write(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The written edges, their number and a digest of them all."""
    return measured(edges, "cc", n=F.count(F.lit(1)), digest=F.bit_xor(F.xxhash64("u", "v")))


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> (id, component): the smallest id reachable, for every id
    in a link. No links: no rows."""
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, state = _write(edges)
    while state["n"]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before = state
        edges, state = _write(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        if state == before:
            break
    found = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return found.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
