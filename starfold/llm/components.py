"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).withColumnRenamed("a", "u")
    return (
        both.where(F.col("b") > F.col("a"))
        .join(least, F.col("a") == F.col("u"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    moved = down.join(least, F.col("a") == F.col("u")).where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    `edges` has two long columns a, b without nulls and loops. Every step is a few joins on the
    link table, written below the shared folder; the number of rounds grows with the logarithm of
    the longest chain. A node with very many links is handled by partial aggregates and split joins.
    """
    now = materialize(edges.select("a", "b").distinct(), "links")
    state = None
    while True:
        now = materialize(_small_star(_large_star(now)), "links-round")
        found = now.agg(
            F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h")
        ).first()
        if (found["n"], found["h"]) == state:
            break
        state = (found["n"], found["h"])
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(roots)
