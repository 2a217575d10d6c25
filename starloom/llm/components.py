"""Connected components of a graph given as edges, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_through


def component_roots(edges: DataFrame) -> DataFrame:
    """For every node of the edges (a, b) but each component's smallest: a, and b = that smallest node.

    Rounds of two steps, both of which keep what is connected: a node's smaller neighbours all point to the smallest
    of them, and a node whose neighbour points elsewhere points there as well.  Each round's table is written to the
    shared folder, so both sides of a join are read anew and Spark can split the rows of a much-pointed-at node.
    """
    e = write_through(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "edges"
    )
    while True:
        least = e.groupBy("a").agg(F.min("b").alias("p"), F.count("*").alias("n"))
        pointed = e.select(F.col("b").alias("a")).distinct()
        if least.filter("n > 1").isEmpty() and least.join(pointed, "a", "left_semi").isEmpty():
            return e
        least = least.select("a", "p")
        gathered = e.join(least, "a").select(F.col("b").alias("a"), F.col("p").alias("b")).filter("a > b")
        e = write_through(least.withColumnRenamed("p", "b").union(gathered).distinct(), "edges")
        further = write_through(
            e.groupBy(F.col("a").alias("b")).agg(F.min(F.col("b")).alias("q")), "parents"
        )
        jumped = e.join(further, "b", "left").select("a", F.coalesce("q", "b").alias("b"))
        kept = further.select(F.col("b").alias("a"), F.col("q").alias("b"))
        e = write_through(jumped.union(kept).distinct(), "edges")
