"""Connected components of an edge table, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch


def _star(edges: DataFrame, large: bool, keep=lambda df: df) -> DataFrame:
    """Hang the neighbours of each node on its least neighbour: the larger ones (large star) or the smaller ones (small star).

    `keep` may write the least neighbours: then Spark can split the edges of a node with many in the join with them.
    """
    if large:
        around = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = keep(around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    hung = around.join(least, "u")
    if large:
        out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, u: str, v: str, tables: Scratch, name: str) -> DataFrame:
    """node, root for every node of an undirected edge table of longs; root is the least node that can be reached.

    Rounds are written tables, and what reaches the driver is a count and a checksum of each.
    """
    now = tables.put(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v").distinct(), f"{name}0")
    seen, turn = None, 0
    while True:
        turn += 1
        now = tables.put(_star(_star(now, True, lambda df, k=turn: tables.put(df, f"{name}{k}-least")), False), f"{name}{turn}")
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        tables.drop(f"{name}{turn - 1}", f"{name}{turn}-least")
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
