"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(links: DataFrame, folder: str, rounds: int = 60) -> DataFrame:
    """(id, component) of each id in links (a, b): component is the smallest id reachable, itself included.

    Each round links all larger neighbours of an id to the smallest id of its neighbourhood, then all smaller ones; a
    hot id's neighbours only meet in a minimum. Each round is a written table, so no lineage grows. It ends when every
    component is a star; more than `rounds` rounds (beyond 2^30 ids in a path) are an error.
    """
    edges = written(links.filter("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), folder, "edges")
    for k in range(rounds):
        # Large star: every neighbour above an id goes to the smallest of the id and its neighbours.
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("m").alias("u"), "v").distinct()
        # Small star: the neighbours below an id, and itself, go to the smallest of them.
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.explode(F.array("u", "v")).alias("v"), F.col("m").alias("u")).filter("v <> u").distinct()
        new = written(small.select("u", "v"), folder, f"edges{k}")
        sums = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
        if new.agg(*sums).first() == edges.agg(*sums).first():
            break
        edges = new
    else:
        raise RuntimeError("the components did not settle")
    return edges.select(F.col("v").alias("id"), F.col("u").alias("component")).unionByName(edges.select(F.col("u").alias("id"), F.col("u").alias("component"))).distinct()
