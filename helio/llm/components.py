"""Connected components of a link table, by alternating stars.

Every node ends up linked with the smallest node that it can reach. Each round is written to the
shared checkpoint folder, which cuts the lineage and survives lost executors, and the round before is
deleted: one table is left, the last that ``materialize`` wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helio.session import WRITTEN, discard, materialize

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the smallest of them; v < u holds."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns u, v); null ends are ignored."""
    current = materialize(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    before = _mark(current)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        current = materialize(_small_star(_large_star(current)), "links")
        discard(edges.sparkSession, WRITTEN.paths[-2:-1])
        after = _mark(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components have not settled")
    roots = current.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
