"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.checkpoints import stage
from ratingloom.operators.lookup import unique_lookup


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest node of each neighbourhood.

    Large star: of a node's neighbours, the larger ones hang on the smallest of all.
    Small star: a node and its smaller neighbours hang on the smallest of them.  The
    smallest neighbour is an aggregate that tasks prepare; no neighbourhood is gathered,
    and the edges of a node with very many of them meet it in many tasks.
    """
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = stage(least.select(F.col("a").alias("_u"), F.least("a", "m").alias("m")), "least")
        joined = unique_lookup(both.filter(F.col("b") > F.col("a")), least, "a", "_u", "inner")
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = stage(edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "_u"), "least")
        joined = unique_lookup(edges, least, "a", "_u", "inner")
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("_u").alias("a"), F.col("m").alias("b"))
        )
    return out.filter(F.col("a") > F.col("b")).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, component (its smallest node) for every node of the edges (a, b).

    Every round is written to the shared folder and the rounds end when nothing moves:
    then every node but the smallest of its component points at that one.  Edges of a node
    to itself say nothing and are left out.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stage(ordered.filter(F.col("a") > F.col("b")).distinct(), name)
    while True:
        # a forest of stars: no parent has a parent, and nobody has two
        parents = now.select(F.col("b").alias("_p")).distinct()
        chained = not now.join(parents, F.col("a") == F.col("_p"), "left_semi").isEmpty()
        if not chained:
            double = now.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1")
            if double.isEmpty():
                break
        now = stage(_star(stage(_star(now, large=True), name), large=False), name)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
