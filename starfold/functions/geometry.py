"""Vectors, orbital frames and Kepler elements as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from starfold.functions.numeric import ColumnLike, col, div, norm3

Vec = tuple[Column, Column, Column]


def vec(x: ColumnLike, y: ColumnLike, z: ColumnLike) -> Vec:
    return col(x), col(y), col(z)


def dot(a: Vec, b: Vec) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: Vec, b: Vec) -> Vec:
    return (
        a[1] * b[2] - a[2] * b[1],
        a[2] * b[0] - a[0] * b[2],
        a[0] * b[1] - a[1] * b[0],
    )


def scale(a: Vec, s: Column) -> Vec:
    return a[0] * s, a[1] * s, a[2] * s


def unit(a: Vec) -> Vec:
    """Unit vector; NULL components for a zero vector."""
    n = norm3(*a)
    return div(a[0], n), div(a[1], n), div(a[2], n)


def orbital_frame(rg: Vec, vg: Vec) -> dict[str, Vec]:
    """Radial, tangential and angular-momentum directions of the cluster's galactic orbit."""
    e_r = unit(rg)
    e_l = unit(cross(rg, vg))
    return {"r": e_r, "t": cross(e_l, e_r), "l": e_l}


def two_body_offsets(m1: ColumnLike, m2: ColumnLike, rel: Vec) -> tuple[Vec, Vec]:
    """Member positions about the centre of mass; zero for a massless pair."""
    total = col(m1) + col(m2)
    f1 = F.coalesce(div(-col(m2), total), F.lit(0.0))
    f2 = F.coalesce(div(col(m1), total), F.lit(0.0))
    return scale(rel, f1), scale(rel, f2)


def member_orbits(a: ColumnLike, m1: ColumnLike, m2: ColumnLike) -> tuple[Column, Column]:
    """Semi-major axes of both members about the centre of mass (eccentricity is shared)."""
    total = col(m1) + col(m2)
    return (
        F.coalesce(div(col(a) * col(m2), total), F.lit(0.0)),
        F.coalesce(div(col(a) * col(m1), total), F.lit(0.0)),
    )


def _clip1(c: Column) -> Column:
    return F.greatest(F.least(c, F.lit(1.0)), F.lit(-1.0))


def orbit_elements(r: Vec, v: Vec, mu: ColumnLike) -> dict[str, Column]:
    """a, e, inclination, ascending node, argument of periapsis (radians) of a state vector."""
    m = col(mu)
    rn, v2 = norm3(*r), dot(v, v)
    h = cross(r, v)
    hn = norm3(*h)
    vxh = cross(v, h)
    ecc_vec = tuple(div(vxh[i], m) - div(r[i], rn) for i in range(3))
    e = norm3(*ecc_vec)
    # the node vector k x h has no z component
    nx, ny = -h[1], h[0]
    nn = F.sqrt(nx * nx + ny * ny)
    two_pi = F.lit(2.0 * math.pi)
    no_node = nn < 1e-14
    node = F.when(no_node, 0.0).otherwise(F.pmod(F.atan2(ny, nx), two_pi))
    cos_w = _clip1(div(nx * ecc_vec[0] + ny * ecc_vec[1], nn * e))
    w = F.acos(cos_w)
    return {
        "a": div(F.lit(1.0), div(F.lit(2.0), rn) - div(v2, m)),
        "e": e,
        "inclination": F.acos(_clip1(div(h[2], hn))),
        "node": node,
        "periapsis": F.when(no_node | (e < 1e-14), 0.0).otherwise(
            F.when(ecc_vec[2] < 0, two_pi - w).otherwise(w)
        ),
    }


def rotation_matrix(node: ColumnLike, inc: ColumnLike, peri: ColumnLike) -> list[list[Column]]:
    """Rotation from the orbital plane to the inertial frame: Rz(node) Rx(inc) Rz(peri)."""
    co, so = F.cos(col(node)), F.sin(col(node))
    ci, si = F.cos(col(inc)), F.sin(col(inc))
    cw, sw = F.cos(col(peri)), F.sin(col(peri))
    return [
        [co * cw - so * sw * ci, -co * sw - so * cw * ci, so * si],
        [so * cw + co * sw * ci, -so * sw + co * cw * ci, -co * si],
        [sw * si, cw * si, ci],
    ]


def orbit_points_xy(
    a: ColumnLike, e: ColumnLike, inc: ColumnLike, node: ColumnLike, peri: ColumnLike, n: int = 600
) -> Column:
    """Array of n <x, y> structs sampling the projected orbit over one revolution."""
    rot = rotation_matrix(node, inc, peri)
    semi_latus = col(a) * (1.0 - col(e) * col(e))
    step = 2.0 * math.pi / (n - 1)

    def point(k: Column) -> Column:
        nu = k.cast("double") * step
        radius = div(semi_latus, 1.0 + col(e) * F.cos(nu))
        px, py = radius * F.cos(nu), radius * F.sin(nu)
        return F.struct(
            (rot[0][0] * px + rot[0][1] * py).alias("x"),
            (rot[1][0] * px + rot[1][1] * py).alias("y"),
        )

    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), point)
