"""The cluster's galactic orbit and galactocentric energies of its stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starfold.functions import galactic as gal, geometry as geo
from starfold.operators.history import first_row
from starfold.operators.snapshot import SNAPSHOT

_ORBIT = ("rg_x_pc", "rg_y_pc", "rg_z_pc", "vg_x_kmps", "vg_y_kmps", "vg_z_kmps")


def _frame_columns(scalars: DataFrame) -> DataFrame:
    """Cluster position and velocity scaled from N-body units to pc and km/s."""
    return scalars.select(
        *SNAPSHOT,
        *[(F.col(f"rg_{a}_pc") * F.col("rbar_pc")).alias(f"_rg{a}") for a in "xyz"],
        *[(F.col(f"vg_{a}_kmps") * F.col("vstar_kms")).alias(f"_vg{a}") for a in "xyz"],
    )


def star_energies(singles: DataFrame, scalars: DataFrame) -> DataFrame:
    """Specific and mass-weighted kinetic, potential, total energy and L_z of every star."""
    joined = singles.join(_frame_columns(scalars), SNAPSHOT)
    parts = gal.galactic_energy(
        *[F.col(f"{a}_pc") + F.col(f"_rg{a}") for a in "xyz"],
        *[F.col(f"v{a}_kms") + F.col(f"_vg{a}") for a in "xyz"],
    )
    m = F.col("mass_msun")
    specific = joined.select(
        *SNAPSHOT, "object_id", m, *[c.alias(f"{n}_specific") for n, c in parts.items()]
    ).withColumn("e_gal_specific", F.col("e_kin_specific") + F.col("e_pot_specific"))
    names = ("e_kin", "e_pot", "e_gal", "l_z")
    return specific.withColumns({n: m * F.col(f"{n}_specific") for n in names})


def cluster_energies(scalars: DataFrame, mean_mass: DataFrame | None = None) -> DataFrame:
    """The cluster's own point in the energy plane; mass-weighted with a representative mass."""
    frame = _frame_columns(scalars)
    parts = gal.galactic_energy(
        *[F.col(f"_rg{a}") for a in "xyz"], *[F.col(f"_vg{a}") for a in "xyz"]
    )
    out = frame.select(*SNAPSHOT, *[c.alias(f"{n}_specific") for n, c in parts.items()])
    out = out.withColumn("e_gal_specific", F.col("e_kin_specific") + F.col("e_pot_specific"))
    if mean_mass is None:
        return out
    out = out.join(mean_mass.select(*SNAPSHOT, F.col("mass_msun").alias("_m")), SNAPSHOT, "left")
    names = ("e_kin", "e_pot", "e_gal", "l_z")
    return out.withColumns({n: F.col("_m") * F.col(f"{n}_specific") for n in names}).drop("_m")


def orbital_frame_positions(singles: DataFrame, scalars: DataFrame) -> DataFrame:
    """Star positions along the radial, tangential and polar axes of the cluster's orbit.

    Snapshots with a degenerate orbit (no position or no angular momentum) are left out.
    """
    axes = geo.orbital_frame(
        geo.vec("rg_x_pc", "rg_y_pc", "rg_z_pc"), geo.vec("vg_x_kmps", "vg_y_kmps", "vg_z_kmps")
    )
    basis = scalars.select(
        *SNAPSHOT,
        *[c.alias(f"_{name}{a}") for name, v in axes.items() for a, c in zip("xyz", v)],
    ).where(F.col("_lx").isNotNull())
    joined = singles.join(basis, SNAPSHOT)
    pos = geo.vec("x_pc", "y_pc", "z_pc")
    return joined.select(
        *SNAPSHOT,
        "object_id",
        *[
            geo.dot(pos, geo.vec(*[f"_{name}{a}" for a in "xyz"])).alias(f"x_{name}_pc")
            for name in "rtl"
        ],
    )


def orbit_points(scalars_by_file: DataFrame) -> DataFrame:
    """Orbit rows with their source: file, time in the file name and row number in the file."""
    return scalars_by_file.select(
        *SNAPSHOT,
        (F.col("ttot") * F.col("tscale_myr")).alias("time_myr"),
        *_ORBIT,
        "source_hdf5_path",
        "source_file_time",
        "source_row_index",
    )


def deduplicated_orbit(points: DataFrame) -> DataFrame:
    """One row per ttot: the first by (file time, path, row)."""
    return first_row(
        points, SNAPSHOT, "source_file_time", "source_hdf5_path", "source_row_index"
    )
