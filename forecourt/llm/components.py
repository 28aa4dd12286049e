"""Connected components of an edge table by alternating star contractions.

Each round joins edges with the smallest neighbour of their node, both within Spark; a node
with very many neighbours is pre-aggregated for its minimum and split by the adaptive
skew join when its edges are rewritten. Rounds are written to the shared folder, and only
a count and a checksum come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.staging import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or, not `large`, smaller) neighbours to its smallest one."""
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    around = edges.unionByName(turned) if large else edges
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    near = around.join(least, "u")
    if large:
        near = near.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        near = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return near.filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) for every node but the smallest of each component; v is that smallest node.

    `edges` has columns u and v of an ordered type, without nulls; directions, repeats and loops
    do not matter. No edges give no rows.
    """
    now = stage(
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        mark = tuple(
            now.agg(
                F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
            ).first()
        )
        if mark == seen or not mark[0]:
            return now
        seen = mark
        now = stage(_star(_star(now, large=True), large=False), "edges")
