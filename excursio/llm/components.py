"""Connected components of a table of edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from excursio.llm.shared import stored


#: Parts that the neighbours of a node are dealt to when they meet its least neighbour.
SALTS = 16


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """The edges with the row of least whose node is a; a node of very many edges is spread over the salts."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    return salted.join(least.select("*", salts.alias("salt_")), (F.col("a") == F.col("node")) & (F.col("salt") == F.col("salt_")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of its neighbourhood."""
    both = _neighbours(edges)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
    return (_with_least(both.where("b > a"), least).select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), "m")
    moved = _with_least(down, least).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("node").alias("a"), F.col("m").alias("b"))
    return moved.union(own).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (a, b): every node of the edges but the least of a component, with that least.

    edges: two columns a and b of one ordered type; loops, repeats and either direction are
    fine, nulls are dropped. Each round is written to the shared folder. It ends when all
    edges point straight at a least node and a round changes nothing.
    """
    now = stored(edges.where("a IS NOT NULL AND b IS NOT NULL AND a != b").select("a", "b"), "edges")
    state = None
    while True:
        now = stored(_small_star(_large_star(now)), "stars")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == state:
            return now
        state = tuple(mark)
