"""Distributed connected components (alternating large-star / small-star).

DataFrame operations only. Links, components and fingerprints stay in Spark;
the driver sees two numbers a round. Every round is written to the shared
folder, which cuts the lineage and outlives a lost executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens.sources.store import StageScope, stage


def _sizes(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def connected_components(links: DataFrame, a: str = "a", b: str = "b", name: str = "links") -> DataFrame:
    """(node, component): the smallest node of the component each linked node
    is in. Nodes are any orderable type; nulls and loops are ignored; an empty
    table gives an empty table. A hot hub is only ever aggregated with a
    map-side minimum or joined, where adaptive execution splits it."""
    with StageScope(links.sparkSession) as scope:
        e = (
            links.where(F.col(a) != F.col(b))
            .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
            .distinct()
        )
        e = stage(e, f"{name}-0")
        size = _sizes(e)
        while size[0]:
            both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = (
                both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .unionByName(low.where("m < u").select("u", F.col("m").alias("v")))
                .distinct()
            )
            low2 = large.groupBy("u").agg(F.min("v").alias("m"))
            small = (
                large.join(low2, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .unionByName(low2.select("u", F.col("m").alias("v")))
                .distinct()
            )
            before, e = e, stage(small, f"{name}-round")
            scope.free(before)
            after = _sizes(e)
            if after == size:
                break
            size = after
        out = e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
            e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
        )
        return scope.keep(out, f"{name}-components")
