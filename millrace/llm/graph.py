"""Connected components by alternating large-star and small-star steps; every step is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from . import common


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: every larger neighbour of a node goes to the node's least neighbour. Small: the node and its smaller ones do."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    to = both.join(least, "u")
    out = to.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else to.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v"))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for each node of edges (u, v: long): root is the least node that u reaches. Hubs are split by adaptive
    skew joins; the minimum is combined on the map side. Steps go on until one changes nothing, some log n of them; the
    job that writes a step also adds up its sign. No edges: no rows."""

    def step(df):
        seen = Observation()
        out = common.written_at(df.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), "edges")
        return *out, (seen.get["n"], seen.get["h"])

    edges, folder, sign = step(edges.filter("u <> v").distinct())
    while True:
        was = sign
        new, at, sign = step(_star(_star(edges, True), False))
        common.drop_folder(folder)
        edges, folder = new, at
        if sign == was:
            break
    roots = edges.select("u", F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct())
