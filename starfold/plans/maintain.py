"""Maintenance of stored features: label backfill, once-only results."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, functions as F

from starfold.functions.stellar import reconstructed_bin_label
from starfold.operators import backfill as bf
from starfold.plans import fs
from starfold.plans.store import FeatureStore
from starfold.session import drop_work, work_path


def backfill_store(
    store: FeatureStore, simulation_id: str, nzero: int, *, dry_run: bool = False
) -> DataFrame:
    """Recompute unknown labels of the stored binaries, rewriting only files that change.

    Returns the report per source file. A second run finds nothing to change.
    """
    stored = store.read(simulation_id, "snapshot_binaries")
    report = bf.backfill_report(stored, nzero)
    # the report must describe the state before the rewrite
    path = work_path(store.spark, "backfill-report")
    report.write.parquet(path)
    report = store.spark.read.parquet(path)
    changed = report.where(F.col("unknown_before") > F.col("still_unknown")).select(
        "source_hdf5_path"
    )
    if dry_run or changed.isEmpty():
        return report
    rows = stored.join(changed, "source_hdf5_path", "left_semi")
    fixed = rows.withColumn("bin_label", reconstructed_bin_label(nzero))
    staged = work_path(store.spark, "backfill")
    fixed.write.parquet(staged)
    entries = store.manifest(simulation_id, "snapshot_binaries").join(
        changed, "source_hdf5_path", "left_semi"
    )
    store.commit(simulation_id, "snapshot_binaries", store.spark.read.parquet(staged), entries)
    drop_work(store.spark, staged)
    note = {"algorithm_version": 1, "generated_at": time.time(), "nzero": nzero}
    base = store.feature_dir(simulation_id, "snapshot_binaries")
    fs.write_text(store.spark, f"{base}/backfill_bin_label.json", json.dumps(note))
    return report


def validate_backfill(
    store: FeatureStore, simulation_id: str, nzero: int
) -> dict[str, Any]:
    """Confusion counts, accuracy and NZERO consistency over the rows with real labels."""
    rows = store.read(simulation_id, "snapshot_binaries")
    counts = bf.confusion(rows, nzero)
    found = counts.collect()  # at most 4 x 4 rows
    n = sum(r["n"] for r in found)
    right = sum(r["n"] for r in found if r["true_label"] == r["predicted_label"])
    lowest = rows.where("bin_label = 1").agg(F.min("cm_id")).first()[0]
    return {
        "confusion": {(r["true_label"], r["predicted_label"]): r["n"] for r in found},
        "n_known": n,
        "accuracy": right / n if n else None,
        "nzero_consistent": lowest is None or lowest > nzero,
    }


def nzero_of(store: FeatureStore, simulation_id: str) -> int:
    """NZERO inferred from the stored scalars."""
    row = bf.infer_nzero(store.read(simulation_id, "snapshot_scalars")).first()
    if row is None:
        raise ValueError(f"no scalars for {simulation_id!r}; give NZERO explicitly")
    return int(row["nzero"])


def once(
    store: FeatureStore,
    simulation_id: str,
    feature: str,
    compute: Callable[[], DataFrame],
    *,
    update: bool = True,
    force: bool = False,
) -> DataFrame:
    """A result computed once per simulation; `update=False` only reads."""
    if force or not store.has(simulation_id, feature):
        if not update:
            raise FileNotFoundError(f"{feature!r} of {simulation_id!r} is not stored")
        store.write_table(simulation_id, feature, compute())
    return store.read(simulation_id, feature)
