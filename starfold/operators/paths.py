"""Longest paths in a graph of dependencies, by contraction in Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starfold.session import materialize, work_path


def longest_paths(nodes: DataFrame, links: DataFrame, limit: int | None = None) -> DataFrame:
    """(id, value): the largest of a node's base and of w + value over its links.

    `nodes` has (id, base), `links` (id, pred, w), w at least 0. In every round a node takes over the values of links
    that are settled, and passes through nodes that depend on one other node only: their link becomes its own, as in
    pointer doubling. So a chain of n nodes is settled in log2(n) rounds, a tree in as many as it has levels at most;
    nodes without links are settled. Each round is a join of two tables, written to the shared folder; a settled node
    that no link leads to any more is written once and in no later round, so what is written shrinks with the links.

    Graphs that may have cycles need `limit`, the longest path that can be (with w = 1: the number of nodes). Nodes on
    a cycle, and those that depend on one, have no value and are left out: a link grows past the limit, or
    a round changes nothing.
    """
    links = materialize(links.groupBy("id", "pred").agg(F.max(F.col("w").cast("bigint")).alias("w")), "path-links")
    written: list[str] = []
    state = _state(nodes.select("id", F.col("base").cast("bigint").alias("base"), F.lit(False).alias("lost")), links, written)
    mark = None
    while not links.isEmpty():
        if limit is not None:
            now = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("id", "pred", "w").cast("decimal(38,0)")).alias("h")).first()
            if mark == (now["n"], now["h"]):
                break
            mark = (now["n"], now["h"])
        told = state.select(F.col("id").alias("pred"), *[F.col(c).alias(f"_{c}") for c in ("base", "n", "one", "lost")])
        through = F.col("_n") == 1
        settled = (F.col("_n") == 0) & ~F.col("_lost")
        moved = links.join(told, "pred").select(
            "id",
            F.when(through, F.col("_one")["pred"]).when(~settled & ~F.col("_lost"), F.col("pred")).alias("pred"),
            (F.col("w") + F.when(through, F.col("_one")["w"]).otherwise(0)).alias("w"),
            F.when(settled | through, F.col("w") + F.col("_base")).alias("gain"),
            F.col("_lost").alias("lost"),
        )
        if limit is not None:
            moved = moved.withColumn("lost", F.col("lost") | (F.col("w") > limit))
        moved = materialize(moved, "path-round")
        told = moved.groupBy("id").agg(F.max("gain").alias("gain"), F.max("lost").alias("_now_lost"))
        raised = state.join(told, "id", "left").select(
            "id", F.greatest("base", "gain").alias("base"), (F.col("lost") | F.coalesce("_now_lost", F.lit(False))).alias("lost")
        )
        gone = moved.where("lost").select("id").distinct()
        left = moved.where(F.col("pred").isNotNull()).join(gone, "id", "left_anti")
        links = materialize(left.groupBy("id", "pred").agg(F.max("w").alias("w")), "path-links")
        state = _state(raised, links, written)
    left = state.select("id", "base", "lost", "n")
    # nodes that left the state early, and those of the last round
    done = state.sparkSession.read.schema(left.schema.add("done", "boolean")).parquet(*written).where("done").drop("done")
    return done.unionByName(left).where((F.col("n") == 0) & ~F.col("lost")).select("id", F.col("base").alias("value"))


def _state(nodes: DataFrame, links: DataFrame, written: list[str]) -> DataFrame:
    """(id, base, lost, n, one): the number of links of each node, and the link if it has one.

    Nodes without links that no link leads to are done: they stand in the written table only, whose path is added to `written`.
    """
    one = F.struct("pred", "w")
    here = F.struct(F.col("id"), F.lit(1).alias("n"), F.when(F.lit(True), one).alias("one"))
    there = F.struct(F.col("pred").alias("id"), F.lit(0).alias("n"), F.when(F.lit(False), one).alias("one"))
    found = links.select(F.inline(F.array(here, there))).groupBy("id").agg(F.sum("n").alias("n"), F.max("one").alias("one"))
    joined = nodes.join(found, "id", "left").select(
        "id", "base", "lost", F.coalesce("n", F.lit(0)).alias("n"), "one", F.col("n").isNull().alias("done")
    )
    path = work_path(nodes.sparkSession, "path-state")
    joined.write.parquet(path)
    written.append(path)
    return nodes.sparkSession.read.schema(joined.schema).parquet(path).where(~F.col("done")).drop("done")
