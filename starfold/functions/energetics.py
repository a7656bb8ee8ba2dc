"""Binding energies, hardness classes and gravitational-wave lifetimes of binaries."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from starfold import constants as K
from starfold.functions.numeric import ColumnLike, col, dbl, div

HARD, SOFT, TEMPORARY = "hard", "soft", "temporary"
BINARY_CLASSES = (HARD, SOFT, TEMPORARY)


def binding_energy_nb(
    m1: ColumnLike, m2: ColumnLike, a_au: ColumnLike, zmbar: ColumnLike, rbar_pc: ColumnLike
) -> Column:
    """m1 m2 / (2 a) / (m1 + m2), all in N-body units: per unit of the pair's own mass."""
    m1_nb, m2_nb = div(dbl(m1), zmbar), div(dbl(m2), zmbar)
    a_nb = div(dbl(a_au) / K.PC_TO_AU, rbar_pc)
    return div(div(m1_nb * m2_nb, 2.0 * a_nb), m1_nb + m2_nb)


def mean_core_distance_au(nc: ColumnLike, rc_nb: ColumnLike, rbar_pc: ColumnLike) -> Column:
    """Mean spacing of the nc stars inside the core radius; NULL without a defined core."""
    n, r = dbl(nc), dbl(rc_nb)
    volume_per_star = 4.0 * math.pi * r * r * r / (3.0 * n)
    return F.when((n > 0) & (r > 0), F.cbrt(volume_per_star) * dbl(rbar_pc) * K.PC_TO_AU)


def ebind_over_kt(ebind_nb: ColumnLike, eclose_nb: ColumnLike) -> Column:
    return div(ebind_nb, K.TEMPORARY_EBIND_FACTOR * dbl(eclose_nb))


def binary_class(
    bin_label: ColumnLike,
    a_au: ColumnLike,
    ebind_nb: ColumnLike,
    eclose_nb: ColumnLike,
    core_distance_au: ColumnLike,
) -> Column:
    """hard / temporary / soft, tested in that order; an undefined operand is never temporary."""
    eclose = dbl(eclose_nb)
    weak = (
        (eclose > 0)
        & (dbl(a_au) > dbl(core_distance_au))
        & (dbl(ebind_nb) < K.TEMPORARY_EBIND_FACTOR * eclose)
    )
    return F.when(col(bin_label) == 1, HARD).when(weak, TEMPORARY).otherwise(SOFT)


def tau_gw_myr(
    a_au: ColumnLike, ecc: ColumnLike, m1: ColumnLike, m2: ColumnLike, cap: float | None = None
) -> Column:
    """Gravitational-wave merger time in Myr, capped when `cap` is given; NULL stays NULL."""
    a, e = dbl(a_au), dbl(ecc)
    e2 = e * e
    total = dbl(m1) + dbl(m2)
    # mu * M^2 = m1 m2 (m1 + m2)
    num = K.TAU_GW_MYR * F.pow(a, F.lit(4.0)) * F.pow(F.greatest(1.0 - e2, F.lit(0.0)), F.lit(3.5))
    den = dbl(m1) * dbl(m2) * total * (1.0 + 73.0 * e2 / 24.0 + 37.0 * e2 * e2 / 96.0)
    tau = F.when(e2 <= 1, div(num, den))
    if cap is None:
        return tau
    return F.when(tau.isNotNull(), F.least(tau, F.lit(float(cap))))
