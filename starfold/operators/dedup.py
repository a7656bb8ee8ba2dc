"""Duplicate resolution and upserts keyed by snapshot or source file."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starfold.operators.history import first_row
from starfold.operators.ordered import running_max
from starfold.operators.snapshot import SNAPSHOT
from starfold.session import materialize


def step_winners(steps: DataFrame) -> DataFrame:
    """The authoritative file of every snapshot: latest mtime, then greatest path.

    A plain max aggregation with map-side combine, on step metadata only.
    """
    best = steps.groupBy(*SNAPSHOT).agg(
        F.max(F.struct("mtime", "source_hdf5_path")).alias("w"),
        F.count_distinct("source_hdf5_path").alias("n_files"),
    )
    return best.select(
        *SNAPSHOT,
        F.col("w.source_hdf5_path").alias("source_hdf5_path"),
        F.col("w.mtime").alias("mtime"),
        "n_files",
    )


def step_losers(steps: DataFrame) -> DataFrame:
    """(file, ttot) pairs that lose to another file."""
    key = ["simulation_id", "source_hdf5_path", "ttot"]
    return steps.select(*key).distinct().join(step_winners(steps).select(*key), key, "left_anti")


def upsert(cached: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Cached rows whose key does not occur in `new`, plus all of `new`."""
    keys = keys or SNAPSHOT
    replaced = materialize(new.select(*keys).distinct(), "replaced-keys")
    return cached.join(replaced, keys, "left_anti").unionByName(new, allowMissingColumns=True)


def replace_snapshots(cached: DataFrame, new: DataFrame, scanned: DataFrame) -> DataFrame:
    """Like upsert, but a scanned snapshot without new rows also loses its cached rows."""
    gone = materialize(scanned.select(*SNAPSHOT).distinct(), "scanned-snapshots")
    return cached.join(gone, SNAPSHOT, "left_anti").unionByName(new, allowMissingColumns=True)


def keep_last(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return first_row(rows, keys, *[F.desc(c) for c in order])


def keep_all_but_last(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Compatibility rule of the lagr.7 cleaner: of duplicated times, all but the last row stay."""
    last = rows.groupBy(*keys).agg(
        F.max(F.struct(*order)).alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    joined = rows.join(last, keys)
    keep = (F.col("_n") == 1) | (F.struct(*order) < F.col("_last"))
    return joined.where(keep).drop("_last", "_n")


def forward_only(
    rows: DataFrame,
    keys: list[str],
    time: str,
    seq: str,
    *,
    chunk: list[str] | None = None,
    chunk_width: int = 65_536,
) -> DataFrame:
    """Drop rows whose time lies below the running maximum: leftovers of restarted runs.

    `seq` numbers the rows in source order. Without explicit chunk columns the sequence is cut
    into ranges of `chunk_width`, so no window holds a whole simulation.
    """
    cut = rows
    if chunk is None:
        cut, chunk = rows.withColumn("_chunk", F.floor(F.col(seq) / chunk_width)), ["_chunk"]
    out = running_max(cut, keys, time, chunk=chunk, within=seq, out="_top")
    return out.where(F.col(time) == F.col("_top")).select(*rows.columns)
