"""Milky-Way potential and galactocentric energy / angular momentum."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from starfold import constants as K
from starfold.functions.numeric import ColumnLike, col

_SERIES_TERMS = 160
_SERIES_LIMIT = 40.0


def _lower_gamma(s: float, x: np.ndarray, complete: float) -> np.ndarray:
    """Lower incomplete gamma: power series below the limit, the complete value above it."""
    small = np.minimum(x, _SERIES_LIMIT)
    term = np.full_like(small, 1.0 / s)
    total = term.copy()
    for k in range(1, _SERIES_TERMS):
        term = term * small / (s + k)
        total += term
    series = np.power(small, s) * np.exp(-small) * total
    return np.where(x > _SERIES_LIMIT, complete, series)


@F.pandas_udf(T.DoubleType())
def bulge_potential(radius: pd.Series) -> pd.Series:
    """Bulge potential in units of vo^2 for a radius in units of ro; zero at the centre."""
    r = radius.to_numpy(dtype="float64")
    safe = np.where(r > 0, r, 1.0)
    x = (safe / K.MW_BULGE_RC) ** 2
    mass = 2.0 * np.pi * K.MW_BULGE_RC**1.2 * _lower_gamma(0.6, x, K.GAMMA_0_6)
    shell = 2.0 * np.pi * K.MW_BULGE_RC**0.2 * _lower_gamma(0.1, x, K.GAMMA_0_1)
    return pd.Series(np.where(r > 0, K.MW_BULGE_AMP * (shell - mass / safe), 0.0 * r))


def mw_potential(radius_kpc: ColumnLike, z_kpc: ColumnLike) -> Column:
    """Potential in (km/s)^2 at cylindrical (R, z); disk and halo stay JVM expressions."""
    big_r, z = col(radius_kpc) / K.MW_RO_KPC, col(z_kpc) / K.MW_RO_KPC
    r = F.sqrt(big_r * big_r + z * z)
    flat = K.MW_DISK_A + F.sqrt(z * z + K.MW_DISK_B**2)
    disk = -K.MW_DISK_AMP / F.sqrt(big_r * big_r + flat * flat)
    halo = F.when(r > 0, -K.MW_HALO_AMP * F.log1p(r / K.MW_HALO_A) / r).otherwise(
        -K.MW_HALO_AMP / K.MW_HALO_A
    )
    return K.MW_VO_KMS**2 * (bulge_potential(r) + disk + halo)


def galactic_energy(
    x_pc: ColumnLike,
    y_pc: ColumnLike,
    z_pc: ColumnLike,
    vx: ColumnLike,
    vy: ColumnLike,
    vz: ColumnLike,
) -> dict[str, Column]:
    """Specific kinetic, potential and total energy and L_z from galactocentric coordinates."""
    x, y, z = col(x_pc) / 1000.0, col(y_pc) / 1000.0, col(z_pc) / 1000.0
    u, v, w = col(vx), col(vy), col(vz)
    kinetic = 0.5 * (u * u + v * v + w * w)
    potential = mw_potential(F.sqrt(x * x + y * y), z)
    return {"e_kin": kinetic, "e_pot": potential, "l_z": x * v - y * u}
