"""Connected components of a graph given as edges, and groups split into cells for pairwise work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import shared

# A group of n rows is cut into ceil(sqrt(n) / SPLIT) blocks, and each pair of blocks is a cell.
SPLIT = 8.0


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of edges (a, b), root the smallest node of the component.

    Large-star and small-star steps in turn until the edges no longer change; each round is kept in the shared
    checkpoint folder.  Minima are partial per task, and the joins split skewed hubs under AQE."""
    edges = shared(edges.where(F.col("a") != F.col("b"))
                   .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(edges)
    while mark[0]:
        both = shared(edges.union(edges.select("b", "a")).toDF("u", "v"))
        least = shared(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        # every larger neighbour of u is linked to the smallest node around u
        large = (both.where(F.col("v") > F.col("u")).join(least, "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        large = shared(large)
        # u and its smaller neighbours are linked to the smallest of them
        least = shared(large.groupBy("a").agg(F.min("b").alias("m")))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b"))
                 .union(least.select("a", F.col("m").alias("b"))).distinct())
        edges, before = shared(small), mark
        mark = _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).union(roots)


def cells(rows: DataFrame, keys: list[str], member: str) -> DataFrame:
    """The rows of groups (equal ``keys``) with two or more members, dealt into cells: lo, hi, block.

    A group is cut by a hash of ``member`` into blocks (rows that share a member share the block) and every pair of
    blocks (lo <= hi) is a cell, so two rows of a group meet in a cell and no cell holds a whole large group.  A row
    goes to as many cells as its group has blocks, at most sqrt(n) / SPLIT + 1 of them."""
    sizes = shared(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("cell_n")).where(F.col("cell_n") > 1))
    many = rows.join(sizes, keys).withColumn("cell_blocks", F.ceil(F.sqrt("cell_n") / SPLIT).cast("int"))
    many = many.withColumn("block", F.pmod(F.xxhash64(F.lit("cell"), member), "cell_blocks").cast("int"))
    many = many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cell_blocks") - 1)))
    return many.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).drop(
        "other", "cell_blocks", "cell_n")
