"""Compact-object history and compact-binary statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starfold.functions import stellar, tags
from starfold.operators.snapshot import SNAPSHOT, with_radius

_D = "double"


def compact_object_history(
    singles: DataFrame, binaries: DataFrame, scalars: DataFrame
) -> DataFrame:
    """One row per compact star per snapshot, single or member of a pair.

    The type filter runs before the scalars join, on the narrow scan of each fact table.
    """
    null_id, null_num = F.lit(None).cast("bigint"), F.lit(None).cast(_D)
    path = lambda df: (
        F.col("source_hdf5_path")
        if "source_hdf5_path" in df.columns
        else F.concat(F.lit("lake/"), "simulation_id")
    )
    stars = with_radius(singles.where(tags.is_compact("kw"))).select(
        *SNAPSHOT,
        F.col("object_id").cast("bigint").alias("object_id"),
        F.col("kw").cast("bigint").alias("kw"),
        F.col("mass_msun").cast(_D).alias("mass_msun"),
        *[F.col(f"{a}_pc").cast(_D).alias(f"{a}_pc") for a in "xyz"],
        *[F.col(f"v{a}_kms").cast(_D).alias(f"v{a}_kms") for a in "xyz"],
        F.col("r_pc").cast(_D).alias("r_pc"),
        F.lit(False).alias("is_in_binary"),
        null_id.alias("companion_id"),
        null_id.alias("companion_kw"),
        null_id.alias("binary_cm_id"),
        null_num.alias("companion_mass_msun"),
        null_num.alias("semi_major_axis_au"),
        null_num.alias("eccentricity"),
        path(singles).alias("source_hdf5_path"),
    )

    def member(i: int) -> Column:
        o = 3 - i
        return F.struct(
            F.col(f"object_id_{i}").cast("bigint").alias("object_id"),
            F.col(f"kw_{i}").cast("bigint").alias("kw"),
            F.col(f"mass_{i}_msun").cast(_D).alias("mass_msun"),
            F.col(f"object_id_{o}").cast("bigint").alias("companion_id"),
            F.col(f"kw_{o}").cast("bigint").alias("companion_kw"),
            F.col(f"mass_{o}_msun").cast(_D).alias("companion_mass_msun"),
        )

    pairs = with_radius(binaries.where(tags.is_compact("kw_1") | tags.is_compact("kw_2")), "cm_")
    members = pairs.select("*", F.explode(F.array(member(1), member(2))).alias("s")).where(
        tags.is_compact("s.kw")
    )
    members = members.select(
        *SNAPSHOT,
        "s.object_id",
        "s.kw",
        "s.mass_msun",
        *[F.col(f"cm_{a}_pc").cast(_D).alias(f"{a}_pc") for a in "xyz"],
        *[F.col(f"cm_v{a}_kms").cast(_D).alias(f"v{a}_kms") for a in "xyz"],
        F.col("r_pc").cast(_D).alias("r_pc"),
        F.lit(True).alias("is_in_binary"),
        "s.companion_id",
        "s.companion_kw",
        F.col("cm_id").cast("bigint").alias("binary_cm_id"),
        "s.companion_mass_msun",
        F.col("semi_major_axis_au").cast(_D).alias("semi_major_axis_au"),
        F.col("eccentricity").cast(_D).alias("eccentricity"),
        path(binaries).alias("source_hdf5_path"),
    )
    times = scalars.select(*SNAPSHOT, (F.col("ttot") * F.col("tscale_myr")).alias("time_myr"))
    both = stars.unionByName(members).join(times, SNAPSHOT, "left")
    first = [*SNAPSHOT, "time_myr", "object_id", "kw"]
    rest = [c for c in stars.columns if c not in (*SNAPSHOT, "object_id", "kw")]
    return both.select(*first, stellar.object_type("kw").alias("object_type"), *rest)


def compact_binary_hits(binaries: DataFrame, scalars: DataFrame) -> DataFrame:
    """One row per pair, snapshot and category (a pair may be in two categories)."""
    hits = binaries.select(
        *SNAPSHOT,
        F.explode(tags.compact_categories("kw_1", "kw_2")).alias("category"),
        F.least("object_id_1", "object_id_2").cast("bigint").alias("bin_name1"),
        F.greatest("object_id_1", "object_id_2").cast("bigint").alias("bin_name2"),
        F.col("kw_1").cast("int").alias("kw1"),
        F.col("kw_2").cast("int").alias("kw2"),
        F.concat_ws(
            "-",
            F.coalesce(stellar.kw_name("kw_1"), F.col("kw_1").cast("string")),
            F.coalesce(stellar.kw_name("kw_2"), F.col("kw_2").cast("string")),
        ).alias("stellar_type"),
    )
    times = scalars.select(*SNAPSHOT, (F.col("ttot") * F.col("tscale_myr")).alias("time_myr"))
    return hits.join(times, SNAPSHOT, "left")


def compact_binary_summary(hits: DataFrame) -> DataFrame:
    """First and last sighting of every pair per category; ties go to the lower / higher types."""
    state = F.struct("ttot", "kw1", "kw2", "time_myr", "stellar_type")
    out = hits.groupBy("simulation_id", "category", "bin_name1", "bin_name2").agg(
        F.min(state).alias("a"),
        F.max(state).alias("z"),
        F.count(F.lit(1)).alias("n_snapshots_seen_in_category"),
    )
    return out.select(
        "simulation_id",
        "category",
        "bin_name1",
        "bin_name2",
        F.col("a.ttot").alias("first_ttot"),
        F.col("z.ttot").alias("last_ttot"),
        F.col("a.time_myr").alias("first_time_myr"),
        F.col("z.time_myr").alias("last_time_myr"),
        F.col("a.kw1").alias("first_kw1"),
        F.col("a.kw2").alias("first_kw2"),
        F.col("z.kw1").alias("last_kw1"),
        F.col("z.kw2").alias("last_kw2"),
        F.col("a.stellar_type").alias("first_stellar_type"),
        F.col("z.stellar_type").alias("last_stellar_type"),
        "n_snapshots_seen_in_category",
    )


def compact_binary_totals(summary: DataFrame, scalars: DataFrame) -> DataFrame:
    """Pairs per category next to the scan totals, one row per simulation."""
    pairs = summary.groupBy("simulation_id").agg(
        *[
            F.count_if(F.col("category") == c).alias(c)
            for c in ("gw_source", "pulsar", "xray_binary")
        ]
    )
    scan = scalars.groupBy("simulation_id").agg(
        F.count(F.lit(1)).alias("scanned_snapshots"),
        F.max("ttot").alias("max_ttot"),
        F.max(F.col("ttot") * F.col("tscale_myr")).alias("max_time_myr"),
    )
    return scan.join(pairs, "simulation_id", "left").fillna(
        0, ["gw_source", "pulsar", "xray_binary"]
    )
