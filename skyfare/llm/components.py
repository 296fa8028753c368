"""Connected components by alternating large and small stars, on the cluster.

Each round links every node to the least node it knows; rounds are written to
the shared folder, so none repeats an earlier one.  Node degrees come from
partial aggregates, and nodes of very high degree are joined by broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.llm.common import join_by_class
from skyfare.session import write_once


def _star(links: DataFrame, onto_larger: bool) -> DataFrame:
    """One half round over ``links`` (u, v): neighbours of u go to the least node that u knows."""
    least = links.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("degree"))
    least = write_once(least, "components-least")
    met = join_by_class(links, least, "u", "degree")
    if onto_larger:
        return met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (met.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
            .unionByName(least.select("u", F.col("m").alias("v")).filter("u != v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b); root is the least node of its component."""
    def lower(df):
        return (df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .filter("u != v").distinct())

    links = write_once(lower(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "components-links")
    mark = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        stars = write_once(lower(_star(both, onto_larger=True)), "components-large")
        links = write_once(lower(_star(stars, onto_larger=False)), "components-small")
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            break
        mark = now
    roots = links.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
