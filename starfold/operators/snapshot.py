"""Per-snapshot population counts, masses and radii."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starfold import constants as K
from starfold.functions.numeric import norm3, on_grid
from starfold.operators.ordered import select_at_cumulative

SNAPSHOT = ["simulation_id", "ttot"]


def with_radius(df: DataFrame, prefix: str = "") -> DataFrame:
    """Add r_pc from the (prefixed) position columns when the frame does not carry it."""
    if "r_pc" in df.columns:
        return df
    return df.withColumn("r_pc", norm3(f"{prefix}x_pc", f"{prefix}y_pc", f"{prefix}z_pc"))


def object_rows(singles: DataFrame, binaries: DataFrame) -> DataFrame:
    """One (kw, mass_msun, r_pc) row per star: singles and both members of every pair.

    Both members come from one pass over the binaries.
    """
    members = F.inline(
        F.array(
            F.struct(F.col("kw_1").alias("kw"), F.col("mass_1_msun").alias("mass_msun")),
            F.struct(F.col("kw_2").alias("kw"), F.col("mass_2_msun").alias("mass_msun")),
        )
    )
    pairs = with_radius(binaries, "cm_").select(*SNAPSHOT, "r_pc", members)
    stars = with_radius(singles).select(*SNAPSHOT, "r_pc", "kw", "mass_msun")
    return stars.unionByName(pairs)


def half_mass_radius(objects: DataFrame) -> DataFrame:
    """Radius at which the mass summed outwards reaches half of the snapshot's total."""

    def half(total: Column) -> list[tuple[Column, Column]]:
        return [(F.lit(0), 0.5 * total)]

    crossing = select_at_cumulative(objects, SNAPSHOT, "r_pc", "mass_msun", half)
    return crossing.select(*SNAPSHOT, F.col("value").alias("half_mass_radius_pc"))


def population_stats(objects: DataFrame) -> DataFrame:
    """Counts of compact types and total mass per snapshot."""
    kw = F.col("kw")
    return objects.groupBy(*SNAPSHOT).agg(
        F.count_if(kw == K.BH_KW).alias("n_bh"),
        F.count_if(kw == K.NS_KW).alias("n_ns"),
        F.count_if(kw.isin(*K.WD_KW)).alias("n_wd"),
        F.sum(F.nanvl(F.col("mass_msun").cast("double"), F.lit(None).cast("double"))).alias(
            "total_mass_msun"
        ),
    )


def snapshot_summary(scalars: DataFrame, singles: DataFrame, binaries: DataFrame) -> DataFrame:
    """One row per scalars row; snapshots without stars get zeros."""
    objects = object_rows(singles, binaries)
    base = scalars.select(
        *SNAPSHOT,
        (F.col("ttot") * F.col("tscale_myr")).alias("time_myr"),
        F.rint(F.col("n_single").cast("double")).cast("bigint").alias("n_singles"),
        F.rint(F.col("n_binary").cast("double")).cast("bigint").alias("n_binaries"),
        (F.col("rc_nb") * F.col("rbar_pc")).alias("core_radius_pc"),
        "rg_x_pc",
        "rg_y_pc",
        "rg_z_pc",
        "vg_x_kmps",
        "vg_y_kmps",
        "vg_z_kmps",
    )
    joined = base.join(population_stats(objects), SNAPSHOT, "left").join(
        half_mass_radius(objects), SNAPSHOT, "left"
    )

    def zero(name: str, kind: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast(kind).alias(name)

    return joined.select(
        *SNAPSHOT,
        "time_myr",
        "n_singles",
        "n_binaries",
        zero("n_bh", "bigint"),
        zero("n_ns", "bigint"),
        zero("n_wd", "bigint"),
        zero("total_mass_msun", "double"),
        "core_radius_pc",
        zero("half_mass_radius_pc", "double"),
        "rg_x_pc",
        "rg_y_pc",
        "rg_z_pc",
        "vg_x_kmps",
        "vg_y_kmps",
        "vg_z_kmps",
    )


def sample_snapshots(df: DataFrame, every: float | None) -> DataFrame:
    """Rows whose ttot lies on the sampling grid."""
    return df.where(on_grid("ttot", every))


def snapshot_at(df: DataFrame, ttot: float, simulation_id: str | None = None) -> DataFrame:
    """Rows of exactly one snapshot; the equality is pushed down to the scan."""
    rows = df.where(F.col("ttot") == F.lit(float(ttot)))
    return rows if simulation_id is None else rows.where(F.col("simulation_id") == simulation_id)


def snapshot_validity(scalars: DataFrame, singles: DataFrame, binaries: DataFrame) -> DataFrame:
    """Per snapshot: is it described exactly once, and do the row counts match the scalars?"""
    base = scalars.groupBy(*SNAPSHOT).agg(
        F.count(F.lit(1)).alias("n_scalar_rows"),
        F.max("n_single").cast("bigint").alias("n_single"),
        F.max("n_binary").cast("bigint").alias("n_binary"),
    )
    n_s = singles.groupBy(*SNAPSHOT).agg(F.count(F.lit(1)).alias("rows_single"))
    n_b = binaries.groupBy(*SNAPSHOT).agg(F.count(F.lit(1)).alias("rows_binary"))
    out = base.join(n_s, SNAPSHOT, "left").join(n_b, SNAPSHOT, "left")
    out = out.fillna(0, ["rows_single", "rows_binary"])
    return out.withColumns(
        {
            "is_valid": F.col("n_scalar_rows") == 1,
            "counts_match": (F.col("rows_single") == F.col("n_single"))
            & (F.col("rows_binary") == F.col("n_binary")),
        }
    )


def cm_velocity(singles: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Mass-weighted mean velocity per group, flagged when it exceeds 1 km/s."""
    mass = F.sum("mass_msun")
    mean = {
        f"vcm_{axis}_kms": F.try_divide(F.sum(F.col(f"v{axis}_kms") * F.col("mass_msun")), mass)
        for axis in "xyz"
    }
    out = singles.groupBy(*(keys or SNAPSHOT)).agg(*[c.alias(n) for n, c in mean.items()])
    speed = norm3("vcm_x_kms", "vcm_y_kms", "vcm_z_kms")
    return out.withColumns({"vcm_kms": speed, "is_high": speed > 1.0})
