"""Derived columns, classes and extractions of binaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from starfold import constants as K
from starfold.functions import energetics as en, stellar, tags
from starfold.functions import geometry as geo
from starfold.functions.numeric import div
from starfold.operators.snapshot import SNAPSHOT

_SCALAR_COLUMNS = ("zmbar_msun", "rbar_pc", "eclose_nb", "rc_nb", "nc")


def add_energetics(binaries: DataFrame, scalars: DataFrame) -> DataFrame:
    """Join the snapshot's scalars and add binding energy, core spacing and hardness class.

    Keys are (simulation_id, ttot), or ttot alone when either side lacks the simulation. A scalars
    column that does not exist reads as NULL.
    """
    keys = [k for k in SNAPSHOT if k in binaries.columns and k in scalars.columns]
    have = [c for c in _SCALAR_COLUMNS if c in scalars.columns]
    gone = [c for c in _SCALAR_COLUMNS if c not in scalars.columns]
    joined = binaries.join(scalars.select(*keys, *have), keys, "left")
    for name in gone:
        joined = joined.withColumn(name, F.lit(None).cast("double"))
    joined = joined.withColumns(
        {
            "ebind_nb": en.binding_energy_nb(
                "mass_1_msun", "mass_2_msun", "semi_major_axis_au", "zmbar_msun", "rbar_pc"
            ),
            "mean_core_distance_au": en.mean_core_distance_au("nc", "rc_nb", "rbar_pc"),
        }
    )
    return joined.withColumns(
        {
            "ebind_over_kt": en.ebind_over_kt("ebind_nb", "eclose_nb"),
            "binary_class": en.binary_class(
                "bin_label",
                "semi_major_axis_au",
                "ebind_nb",
                "eclose_nb",
                "mean_core_distance_au",
            ),
        }
    )


def add_pair_columns(binaries: DataFrame) -> DataFrame:
    """Primary / secondary masses and types, periastron, radii sum and merger time."""
    m1, m2 = F.col("mass_1_msun"), F.col("mass_2_msun")
    high, low = F.greatest(m1, m2), F.least(m1, m2)
    radii = F.col("radius_1_rsun") + F.col("radius_2_rsun")
    peri = F.col("semi_major_axis_au") * (1 - F.col("eccentricity"))
    return binaries.withColumns(
        {
            "primary_mass_msun": high,
            "secondary_mass_msun": low,
            "total_mass_msun": m1 + m2,
            "mass_ratio": div(low, high),
            "primary_kw": F.greatest("kw_1", "kw_2"),
            "secondary_kw": F.least("kw_1", "kw_2"),
            "stellar_type": stellar.pair_type("kw_1", "kw_2"),
            "peri_au": peri,
            "sum_of_radius_rsun": radii,
            "sum_of_radius_au": radii * K.SOLRAD_TO_AU,
            "peri_over_radius": div(peri, radii * K.SOLRAD_TO_AU),
            "tau_gw_myr": en.tau_gw_myr(
                "semi_major_axis_au", "eccentricity", m1, m2, K.UNIVERSE_AGE_MYR
            ),
        }
    )


def annotate_states(binaries: DataFrame) -> DataFrame:
    """Decoded centre-of-mass state and member types."""
    base1, ce1 = stellar.member_kw("kw_1")
    base2, ce2 = stellar.member_kw("kw_2")
    return binaries.withColumns(
        {
            **stellar.cm_state("cm_kw"),
            "base_kw_1": base1,
            "base_kw_2": base2,
            "in_ce_1": ce1,
            "in_ce_2": ce2,
        }
    )


def drop_temporary(df: DataFrame, class_col: str = "binary_class") -> DataFrame:
    """Rows not classed temporary; rows without a class stay, as does a frame without one."""
    if class_col not in df.columns:
        return df
    return df.where(~F.col(class_col).eqNullSafe(F.lit(en.TEMPORARY)))


def class_counts(classified: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Count and share of each class per group."""
    keys = keys or ["simulation_id"]
    counts = classified.groupBy(*keys, "binary_class").agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(W.partitionBy(*keys))
    return counts.withColumn("frac", F.col("n") / whole)


def with_stellar_type(
    binaries: DataFrame, stellar_type: str | None = None, kw: int | str | None = None
) -> DataFrame:
    """Pairs with at least one member of the given type."""
    code = stellar.resolve_kw(stellar_type, kw)
    return binaries.where((F.col("kw_1") == code) | (F.col("kw_2") == code))


def primordial_binaries(binaries: DataFrame) -> DataFrame:
    """Pairs of the ttot = 0 snapshot whose ids are neighbours."""
    a, b = F.col("object_id_1").cast("bigint"), F.col("object_id_2").cast("bigint")
    return binaries.where((F.col("ttot") == 0.0) & (F.abs(a - b) == 1)).withColumns(
        {
            "primordial_name_min": F.least(a, b),
            "primordial_name_max": F.greatest(a, b),
            "primordial_pair_key": tags.pair_key(a, b),
            "is_primordial_binary": F.lit(True),
        }
    )


def b_type_binaries(binaries: DataFrame, primordial: DataFrame) -> DataFrame:
    """Pairs with a B-type main-sequence member, flagged when the pair is primordial."""
    one = tags.is_b_type("kw_1", "teff_1_k", "mass_1_msun")
    two = tags.is_b_type("kw_2", "teff_2_k", "mass_2_msun")
    rows = binaries.where(one | two).withColumns(
        {
            "b_type_member1": one,
            "b_type_member2": two,
            "b_type_member_count": one.cast("int") + two.cast("int"),
            "b_type_pair_key": tags.pair_key("object_id_1", "object_id_2"),
        }
    )
    known = primordial.select(
        "simulation_id",
        F.col("primordial_pair_key").alias("b_type_pair_key"),
        F.lit(True).alias("_p"),
    ).distinct()
    flagged = rows.join(known, ["simulation_id", "b_type_pair_key"], "left")
    return flagged.withColumn("is_primordial_binary", F.col("_p").isNotNull()).drop("_p")


def pair_orbits(binaries: DataFrame) -> DataFrame:
    """Member offsets and orbits about the centre of mass and the elements of the relative orbit."""
    m1, m2 = F.col("mass_1_msun"), F.col("mass_2_msun")
    rel = geo.vec("rel_x_pc", "rel_y_pc", "rel_z_pc")
    vel = geo.vec("rel_vx_kms", "rel_vy_kms", "rel_vz_kms")
    first, second = geo.two_body_offsets(m1, m2, rel)
    a1, a2 = geo.member_orbits("semi_major_axis_au", m1, m2)
    elements = geo.orbit_elements(rel, vel, K.G_PC_KMS2_MSUN * (m1 + m2))
    return binaries.select(
        *SNAPSHOT,
        "object_id_1",
        "object_id_2",
        *[c.alias(f"{a}1_pc") for a, c in zip("xyz", first)],
        *[c.alias(f"{a}2_pc") for a, c in zip("xyz", second)],
        a1.alias("a1_au"),
        a2.alias("a2_au"),
        *[c.alias(f"orbit_{name}") for name, c in elements.items()],
    )
