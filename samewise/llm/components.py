"""Connected components by min-label propagation with pointer jumping; labels never leave the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samewise.llm.common import remove, saved


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable, for every id on an edge with two ends.

    Alternates the large-star and small-star steps of the published two-step
    algorithm until the edges are stars. Each round's edges are one table.
    Grouping is by minimum only, so no neighbourhood is gathered.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct()
    old: list[str] = []
    pairs, state = saved(pairs, "edges", old), None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: larger neighbours of a node go to the least of its neighbourhood.
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # Small star: a node and its smaller neighbours go to the least of them.
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        new: list[str] = []
        pairs = saved(small, "edges", new)
        remove(pairs.sparkSession, old)
        old = new
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    found = pairs.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    roots = pairs.select(F.col("b").alias("id")).distinct().join(found.select("id"), "id", "left_anti")
    return found.unionByName(roots.withColumn("component", F.col("id")))


def merged_components(found: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component) after more edges (a, b): only the components that they touch are gone through again."""
    of = lambda side: found.select(F.col("id").alias(side), F.col("component").alias(f"c{side}"))
    ends = saved(edges.join(of("a"), "a", "left").join(of("b"), "b", "left").select("a", "b", F.coalesce("ca", "a").alias("x"), F.coalesce("cb", "b").alias("y")), "edges")
    new = connected_components(ends, "x", "y").select(F.col("id").alias("component"), F.col("component").alias("now"))
    alone = ends.select(F.col("a").alias("id")).unionByName(ends.select(F.col("b").alias("id"))).distinct().join(found, "id", "left_anti").withColumn("component", F.col("id"))
    return found.unionByName(alone).join(new, "component", "left").select("id", F.coalesce("now", "component").alias("component"))
