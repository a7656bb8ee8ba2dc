"""Reconstruction of unknown bin_label values and its validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starfold import constants as K
from starfold.functions.stellar import reconstructed_bin_label


def infer_nzero(scalars: DataFrame) -> DataFrame:
    """Initial particle number per simulation: n of the earliest snapshot, which must be ttot 0."""
    first = scalars.groupBy("simulation_id").agg(
        F.min("ttot").alias("_t0"), F.min_by("n", "ttot").cast("bigint").alias("_n")
    )
    message = F.concat(F.lit("earliest ttot is not 0; give NZERO for "), "simulation_id")
    value = F.when(F.abs("_t0") <= 1e-9, F.col("_n")).otherwise(
        F.raise_error(message).cast("bigint")
    )
    return first.select("simulation_id", value.alias("nzero"))


def backfill(binaries: DataFrame, nzero: int | DataFrame) -> DataFrame:
    """Binaries with bin_label recomputed where it is -9. Applying it twice changes nothing."""
    if isinstance(nzero, int):
        return binaries.withColumn("bin_label", reconstructed_bin_label(nzero))
    joined = binaries.join(nzero, "simulation_id", "left")
    return joined.withColumn("bin_label", reconstructed_bin_label("nzero")).drop("nzero")


def backfill_report(
    binaries: DataFrame, nzero: int, part: str = "source_hdf5_path"
) -> DataFrame:
    """What a backfill would change, per source part that has unknown labels."""
    new = reconstructed_bin_label(nzero)
    unknown = binaries.where(F.col("bin_label") == K.BIN_LABEL_UNKNOWN)
    counted = unknown.select("simulation_id", part, new.alias("new"))
    return counted.groupBy("simulation_id", part).agg(
        F.count(F.lit(1)).alias("unknown_before"),
        F.count_if(F.col("new") == 1).alias("to_hard"),
        F.count_if(F.col("new") == 0).alias("to_wide"),
        F.count_if(F.col("new") == -1).alias("to_merger_or_hierarchical"),
        F.count_if(F.col("new") == K.BIN_LABEL_UNKNOWN).alias("still_unknown"),
    )


def confusion(binaries: DataFrame, nzero: int) -> DataFrame:
    """Counts of (true, predicted) label: all known labels are hidden and reconstructed."""
    known = binaries.where(F.col("bin_label") != K.BIN_LABEL_UNKNOWN).select(
        "cm_id",
        "object_id_1",
        "object_id_2",
        "pert_gamma",
        "cm_kw",
        F.col("bin_label").alias("true_label"),
        F.lit(K.BIN_LABEL_UNKNOWN).alias("bin_label"),
    )
    return (
        known.select("true_label", reconstructed_bin_label(nzero).alias("predicted_label"))
        .groupBy("true_label", "predicted_label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def accuracy(confusion_counts: DataFrame) -> DataFrame:
    """Number of known rows and the share reconstructed correctly."""
    return confusion_counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_known"),
        F.try_divide(
            F.sum(F.when(F.col("true_label") == F.col("predicted_label"), F.col("n")).otherwise(0)),
            F.sum("n"),
        ).alias("accuracy"),
    )


def nzero_consistent(binaries: DataFrame, nzero: int) -> DataFrame:
    """Are the centre-of-mass ids of all labelled hard pairs above NZERO?"""
    lowest = F.min(F.when(F.col("bin_label") == 1, F.col("cm_id")))
    return binaries.groupBy("simulation_id").agg(
        F.coalesce(lowest > nzero, F.lit(True)).alias("nzero_consistent")
    )
