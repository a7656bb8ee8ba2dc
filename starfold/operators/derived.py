"""The derived view of the raw snapshot tables that analyses and figures read."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from starfold import constants as K
from starfold.functions import stellar
from starfold.functions.numeric import div, norm3
from starfold.operators.binaries import add_energetics, add_pair_columns
from starfold.operators.snapshot import SNAPSHOT


def relaxation_ratio(n0: int) -> float:
    """Half-mass relaxation time over crossing time for n0 stars."""
    return 0.1 * n0 / math.log(0.4 * n0)


def derived_scalars(scalars: DataFrame) -> DataFrame:
    return scalars.withColumns(
        {
            "time_myr": F.col("ttot") * F.col("tscale_myr"),
            "clight_nb": div(F.lit(3.0e5), "vstar_kms"),
        }
    )


def _times(scalars: DataFrame, n0: int) -> DataFrame:
    return scalars.select(
        *SNAPSHOT,
        (F.col("ttot") * F.col("tscale_myr")).alias("time_myr"),
        "ttot_over_tcr0",
        (F.col("ttot_over_tcr0") / relaxation_ratio(n0)).alias("ttot_over_trh0"),
    )


def centred(df: DataFrame, scalars: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Positions relative to the density centre: raw minus rdens times rbar, per snapshot.

    `columns` maps raw x, y, z columns to the centred names.
    """
    offsets = scalars.select(
        *SNAPSHOT,
        *[(F.col(f"rdens_{a}_nb") * F.col("rbar_pc")).alias(f"_off_{a}") for a in "xyz"],
    )
    joined = df.join(offsets, SNAPSHOT, "left")
    return joined.withColumns(
        {
            out: F.col(raw).cast("double") - F.col(f"_off_{a}")
            for a, (raw, out) in zip("xyz", columns.items())
        }
    ).drop("_off_x", "_off_y", "_off_z")


def uncentred(df: DataFrame, scalars: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Exact inverse of `centred`: centred plus rdens times rbar."""
    offsets = scalars.select(
        *SNAPSHOT,
        *[(F.col(f"rdens_{a}_nb") * F.col("rbar_pc")).alias(f"_off_{a}") for a in "xyz"],
    )
    joined = df.join(offsets, SNAPSHOT, "left")
    return joined.withColumns(
        {
            raw: F.col(pc).cast("double") + F.col(f"_off_{a}")
            for a, (raw, pc) in zip("xyz", columns.items())
        }
    ).drop("_off_x", "_off_y", "_off_z")


def displayed(kw: Column, value: str, limits: tuple[float, float], *, flat: bool) -> Column:
    """Plot value of NS and BH: a flat 1.2 times the lower limit, or clipped to the limits."""
    low, high = limits
    shown = F.lit(low * 1.2) if flat else F.greatest(F.least(F.col(value), F.lit(high)), F.lit(low))
    return F.when(kw.isin(K.NS_KW, K.BH_KW), shown).otherwise(F.col(value))


def derived_singles(singles: DataFrame, scalars: DataFrame, n0: int) -> DataFrame:
    kw = F.col("kw")
    return singles.join(_times(scalars, n0), SNAPSHOT, "left").withColumns(
        {
            "r_pc": norm3("x_pc", "y_pc", "z_pc"),
            "speed_kms": norm3("vx_kms", "vy_kms", "vz_kms"),
            "stellar_type": stellar.kw_verbose("kw"),
            "luminosity_display": displayed(
                kw, "luminosity_lsun", K.DISPLAY_LIMITS["L*"], flat=True
            ),
            "teff_display": displayed(kw, "teff_k", K.DISPLAY_LIMITS["Teff*"], flat=False),
        }
    )


def derived_binaries(binaries: DataFrame, scalars: DataFrame, n0: int) -> DataFrame:
    timed = binaries.join(_times(scalars, n0), SNAPSHOT, "left")
    out = add_pair_columns(add_energetics(timed, scalars)).withColumn(
        "r_pc", norm3("cm_x_pc", "cm_y_pc", "cm_z_pc")
    )
    return out.withColumn("is_hard_binary", F.col("binary_class") == "hard")


def derived_mergers(mergers: DataFrame, scalars: DataFrame, n0: int) -> DataFrame:
    return mergers.join(_times(scalars, n0), SNAPSHOT, "left")
