"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.session import cut_lineage


def _stars(edges: DataFrame, upward: bool) -> DataFrame:
    """Each node's neighbours linked to its smallest neighbour (or itself):
    neighbours above the node if ``upward``, else those below and the node."""
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    near = edges.unionByName(turned) if upward else edges
    lowest = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    pairs = near.join(lowest, "u")
    if upward:
        found = pairs.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        found = (pairs.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(lowest.select("u", F.col("m").alias("v"))))
    return found.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) for every node of ``edges`` (u, v): comp is the smallest id of
    its component. Alternates large and small stars, which ends after about
    log(diameter) rounds; minima are combined before each shuffle, and each
    round is a Parquet table. Loops and repeated edges do no harm."""
    edges = (edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    edges, before = cut_lineage(edges, "edges"), None
    mark = (F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)")))
    while (now := tuple(edges.agg(*mark).first())) != before and now[0]:
        before = now
        edges = cut_lineage(_stars(_stars(edges, True), False), "edges")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("comp"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(roots).distinct()
