"""Mappings from physical values to plot attributes."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, functions as F

from starfold import constants as K
from starfold.functions.numeric import ColumnLike, col


def luminosity_alpha(lum: ColumnLike, low: ColumnLike, high: ColumnLike) -> Column:
    """Min-max scaled log10 luminosity; exactly 1e-10 is drawn opaque."""
    log_l = F.log10(col(lum))
    a, b = F.log10(col(low)), F.log10(col(high))
    return F.when(log_l == -10, 1.0).otherwise(F.try_divide(log_l - a, b - a))


def mass_radius(
    mass: ColumnLike,
    *,
    mass_min: float = 0.1,
    mass_max: float = 100.0,
    radius_min: float = 0.12,
    radius_max: float = 0.85,
    scale: str = "sqrt",
) -> Column:
    """Bounded circle radius for a mass, by square root or logarithm."""
    m = F.greatest(F.least(col(mass), F.lit(mass_max)), F.lit(mass_min))
    if scale == "sqrt":
        share = F.sqrt((m - mass_min) / (mass_max - mass_min))
    elif scale == "log":
        low = math.log10(mass_min)
        share = (F.log10(m) - low) / (math.log10(mass_max) - low)
    else:
        raise ValueError(f"scale must be 'sqrt' or 'log', not {scale!r}")
    return radius_min + share * (radius_max - radius_min)


def marker_size(radius_rsun: ColumnLike) -> Column:
    """Scatter-marker area whose radius grows with log10 of the stellar radius."""
    low, high = (math.log10(v) for v in K.DISPLAY_LIMITS["R*"])
    side_min, side_max = math.sqrt(10.0), math.sqrt(10000.0)
    log_r = F.log10(F.greatest(col(radius_rsun), F.lit(K.DISPLAY_LIMITS["R*"][0])))
    side = side_min + (log_r - low) / (high - low) * (side_max - side_min)
    return side * side


# Multi-lobe Gaussian fit of the CIE 1931 colour-matching functions
# (amplitude, centre nm, left width, right width), Wyman, Sloan & Shirley 2013.
_CIE_LOBES = {
    "x": ((1.056, 599.8, 37.9, 31.0), (0.362, 442.0, 16.0, 26.7), (-0.065, 501.1, 20.4, 26.2)),
    "y": ((0.821, 568.8, 46.9, 40.5), (0.286, 530.9, 16.3, 31.1)),
    "z": ((1.217, 437.0, 11.8, 36.0), (0.681, 459.0, 26.0, 13.8)),
}
# XYZ to linear sRGB (D65).
XYZ_TO_RGB = np.array(
    [
        [3.2404542, -1.5371385, -0.4985314],
        [-0.9692660, 1.8760108, 0.0415560],
        [0.0556434, -0.2040259, 1.0572252],
    ]
)


WAVELENGTHS_NM = np.arange(380.0, 781.0, 5.0)
# Second radiation constant, nm K.
C2_NM_K = 1.4387768775e7


def matching_curves() -> np.ndarray:
    """Colour-matching values x, y, z at every wavelength."""
    curves = []
    for axis in "xyz":
        curve = np.zeros_like(WAVELENGTHS_NM)
        for amp, centre, left, right in _CIE_LOBES[axis]:
            width = np.where(WAVELENGTHS_NM < centre, left, right)
            curve += amp * np.exp(-0.5 * ((WAVELENGTHS_NM - centre) / width) ** 2)
        curves.append(curve)
    return np.array(curves)


def blackbody_chromaticity(kelvin: np.ndarray) -> np.ndarray:
    """Shares of X and Y in X + Y + Z of black bodies, one column for each temperature."""
    exponent = C2_NM_K / (WAVELENGTHS_NM[None, :] * np.asarray(kelvin, dtype="float64")[:, None])
    spectrum = WAVELENGTHS_NM[None, :] ** -5.0 / np.expm1(np.minimum(exponent, 700.0))
    xyz = spectrum @ matching_curves().T
    return (xyz / xyz.sum(axis=1, keepdims=True))[:, :2].T


# The table covers these temperatures; colours don't change visibly beyond.
COOLEST_K, HOTTEST_K = 500.0, 1.0e6
INTERVALS = 512


@lru_cache(maxsize=1)
def chromaticity_table() -> list[list[list[float]]]:
    """For x and y the coefficients of 1, t, t^2, t^3 in each interval of the logarithm of the temperature.

    Cubic Hermite pieces from values and slopes at the knots; shares are smooth in the logarithm, so they are
    exact to about 1e-10. The kinks of a colour, clipping and gamma, are applied after the interpolation.
    """
    step = math.log(HOTTEST_K / COOLEST_K) / INTERVALS
    at = math.log(COOLEST_K) + step * np.arange(INTERVALS + 1)
    value = blackbody_chromaticity(np.exp(at))
    d = 1e-4
    points = [blackbody_chromaticity(np.exp(at + k * d)) for k in (-2, -1, 1, 2)]
    slope = step * (points[0] - 8 * points[1] + 8 * points[2] - points[3]) / (12 * d)
    a, b, u, v = value[:, :-1], value[:, 1:], slope[:, :-1], slope[:, 1:]
    pieces = [a, u, 3 * (b - a) - 2 * u - v, 2 * (a - b) + u + v]
    return [[part[axis].tolist() for part in pieces] for axis in range(2)]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def teff_rgb(teff: ColumnLike) -> Column:
    """Display colour (r, g, b in 0..1, brightest channel 1) of a black body of this temperature.

    An interval of the table is found by the logarithm of the temperature; all steps are column expressions. The table
    is a constant, folded when the query is planned.
    """
    low, step = math.log(COOLEST_K), math.log(HOTTEST_K / COOLEST_K) / INTERVALS
    pieces = zip(*[part for axis in chromaticity_table() for part in axis])
    table = F.expr(f"array({', '.join('array(' + ', '.join(f'{v!r}D' for v in row) + ')' for row in pieces)})")
    kelvin = F.least(F.greatest(col(teff).cast("double"), F.lit(COOLEST_K)), F.lit(HOTTEST_K))
    place = (F.ln(kelvin) - low) / step

    def shares(p: Column) -> Column:
        index = F.least(F.greatest(F.floor(p), F.lit(0)), F.lit(INTERVALS - 1)).cast("int")
        return F.concat(F.get(table, index), F.array(p - index))

    def linear(c: Column) -> Column:
        t = c[8]
        x, y = (c[k] + t * (c[k + 1] + t * (c[k + 2] + t * c[k + 3])) for k in (0, 4))
        return F.array(x, y, 1.0 - x - y)

    def bright(s: Column) -> Column:
        return F.array(*[F.greatest(sum(float(m) * s[k] for k, m in enumerate(row)), F.lit(0.0)) for row in XYZ_TO_RGB])

    def scaled(c: Column) -> Column:
        return F.transform(c, lambda v: v / F.array_max(c))

    def gamma(c: Column) -> Column:
        out = [F.when(c[k] <= 0.0031308, 12.92 * c[k]).otherwise(1.055 * F.pow(c[k], 1 / 2.4) - 0.055) for k in range(3)]
        return F.struct(*[v.alias(n) for n, v in zip("rgb", out)])

    steps = _let(_let(_let(_let(_let(place, shares), linear), bright), scaled), gamma)
    return F.when(col(teff).isNotNull(), steps)
