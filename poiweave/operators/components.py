"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from poiweave.storage import discard, materialise


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a written table, and their number and sum of hashes, taken while they are written."""
    seen = Observation()
    table = materialise(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")), "edges")
    return table, (seen.get["n"], seen.get["s"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node of its neighbourhood."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = both.where("v > u").join(least, "u")
    return out.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them. Edges point down."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Components of an undirected graph: ``(id, component)`` with the smallest id as the component.

    Only nodes that occur in an edge are returned. Null ends and loops are dropped; repeated edges
    count once; an empty edge table gives an empty result. Every step is a keyed aggregate and an
    equi-join (hot nodes are pre-aggregated, then split by AQE), and writes its result to the shared
    folder, so a lost executor costs one step.
    """
    pair = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    now, seen = _written(pair.where("_a is not null and _b is not null and u <> v").select("u", "v").distinct())
    while seen[0]:
        before, old = seen, now
        now, seen = _written(_small_star(_large_star(old)))
        discard(old)
        if seen == before:
            break
    roots = now.select(F.col("v").alias("id")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(
        roots.select("id", F.col("id").alias("component"))
    )
