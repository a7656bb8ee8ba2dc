import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starfold import constants as K
from starfold.functions import display, energetics as en, galactic, geometry as geo, stellar, tags
from starfold.functions.numeric import on_grid, order_bin, round_id


def values(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_binary_class_priority_and_undefined_operands(spark):
    rows = [
        (1, 1e9, 1e-9, 1.0, 1.0),  # label wins
        (0, 10.0, 1e-5, 1.0, 5.0),  # wide and weak
        (-9, 10.0, 1.0, 1.0, 5.0),  # wide but bound
        (-9, 1.0, 1e-5, 1.0, 5.0),  # weak but close
        (0, 10.0, 1e-5, 0.0, 5.0),  # no threshold
        (0, 10.0, 1e-5, 1.0, float("nan")),
        (0, float("nan"), 1e-5, 1.0, 5.0),
        (0, 10.0, float("nan"), 1.0, 5.0),
        (1, float("nan"), float("nan"), float("nan"), float("nan")),
    ]
    df = spark.createDataFrame(rows, "l int, a double, e double, c double, d double")
    got = [r[0] for r in values(df, en.binary_class("l", "a", "e", "c", "d"))]
    assert got == ["hard", "temporary", *["soft"] * 6, "hard"]


def test_core_distance_needs_a_core(spark):
    df = spark.createDataFrame(
        [(100.0, 0.5, 2.0), (0.0, 0.5, 2.0), (100.0, 0.0, 2.0), (float("nan"), 0.5, 2.0)],
        "nc double, rc double, rbar double",
    )
    got = [r[0] for r in values(df, en.mean_core_distance_au("nc", "rc", "rbar"))]
    assert got[0] == pytest.approx((4 * math.pi * 0.125 / 300) ** (1 / 3) * 2 * K.PC_TO_AU)
    assert got[1:] == [None, None, None]


def test_binding_energy_is_per_pair_mass(spark):
    df = spark.createDataFrame([(10.0, 5.0, 1.0)], "m1 double, m2 double, a double")
    got = values(df, en.binding_energy_nb("m1", "m2", "a", F.lit(100.0), F.lit(2.0)))[0][0]
    a_nb = 1.0 / K.PC_TO_AU / 2.0
    assert got == pytest.approx(0.1 * 0.05 / (2 * a_nb) / 0.15)


def test_tau_gw_scaling_and_cap(spark):
    df = spark.createDataFrame(
        [(0.01, 0.0), (0.02, 0.0), (0.01, 0.6), (1000.0, 0.0), (float("nan"), 0.0)],
        "a double, e double",
    )
    tau = [r[0] for r in values(df, en.tau_gw_myr("a", "e", F.lit(30.0), F.lit(20.0), 13800.0))]
    assert tau[1] / tau[0] == pytest.approx(16.0)
    shrink = (1 - 0.36) ** 3.5 / (1 + 73 / 24 * 0.36 + 37 / 96 * 0.36**2)
    assert tau[2] / tau[0] == pytest.approx(shrink)
    assert tau[3] == 13800.0 and tau[4] is None
    # Peters time of a circular 30+20 Msun pair at 0.01 au, SI by hand
    num = 5 * K.C_SI**5 * (0.01 * K.AU_M) ** 4
    den = 64 * K.G_SI**3 * 30 * 20 * 50 * K.MSUN_KG**3
    assert tau[0] == pytest.approx(num / den / K.MYR_S)


def test_cm_state_codes(spark):
    codes = [-25, -1, 0, 5, 10, 11, 12, 13, 14, 21]
    df = spark.createDataFrame([(c,) for c in codes], "k int")
    s = stellar.cm_state("k")
    rows = df.select("k", *[c.alias(n) for n, c in s.items()]).collect()
    by = {r["k"]: r.asDict() for r in rows}
    assert by[-25]["is_relativistic_binary"] and not by[-25]["mt_ongoing"]
    assert by[-1]["is_chaotic_tide_binary"]
    assert by[0]["is_standard"] and not by[5]["is_standard"]
    assert [by[k]["mt_ongoing"] for k in (10, 11, 12, 13)] == [False, True, False, True]
    assert [by[k]["mt_past"] for k in (10, 12, 14)] == [False, True, True]
    assert [by[k]["mt_phase_index"] for k in (10, 11, 12, 13, 21)] == [0, 1, 1, 2, 6]


def test_member_kw_and_labels(spark):
    df = spark.createDataFrame([(114, 14, 1), (13, 13, -1)], "raw int, a int, b int")
    base, ce = stellar.member_kw("raw")
    got = values(df, base, ce, stellar.pair_type("a", "b"), stellar.kw_verbose("b"))
    assert got == [(14, True, "BH-MS", " 1:MS"), (13, False, "NS-PMS", "-1:PMS")]


def test_resolve_kw():
    assert stellar.resolve_kw("bh") == 14
    assert stellar.resolve_kw(kw="13") == 13
    for bad in ({}, {"stellar_type": "BH", "kw": 14}, {"kw": 99}, {"kw": "x"}, {"stellar_type": "q"}):
        with pytest.raises(ValueError):
            stellar.resolve_kw(**bad)


def test_bin_label_rules_in_order(spark):
    rows = [
        (-5, 1, 2, 0.0, -1, -9),  # merger before wide
        (1005, 5, 6, 0.0, -1, -9),  # wide before KS
        (1005, 5, 6, 0.5, 0, -9),  # KS by the first member
        (1006, 5, 6, 0.5, 0, -9),
        (500, 5, 6, 0.1, 0, -9),  # single-precision 0.1
        (500, 5, 6, 0.2, 0, -9),
        (-5, 1, 2, 0.0, -1, 1),  # known label stays
    ]
    df = spark.createDataFrame(
        rows, "cm_id long, object_id_1 long, object_id_2 long, pert_gamma float, cm_kw int, bin_label int"
    )
    once = df.withColumn("bin_label", stellar.reconstructed_bin_label(1000))
    assert [r[0] for r in values(once, "bin_label")] == [-1, 0, 1, 1, -1, -9, 1]
    twice = once.withColumn("bin_label", stellar.reconstructed_bin_label(1000))
    assert values(once, "bin_label") == values(twice, "bin_label")


def test_compact_categories(spark):
    pairs = [(14, 14), (14, 13), (13, 1), (13, 10), (10, 1), (14, 1), (1, 2)]
    df = spark.createDataFrame(pairs, "a int, b int")
    got = [r[0] for r in values(df, tags.compact_categories("a", "b"))]
    assert got == [
        ["gw_source"],
        ["gw_source"],
        ["pulsar", "xray_binary"],
        ["pulsar"],
        ["xray_binary"],
        ["xray_binary"],
        [],
    ]


def test_imbh_bounds_and_pair_keys(spark):
    df = spark.createDataFrame(
        [(14, 100.0), (14, 100.5), (14, 1e5), (13, 500.0), (14, float("nan")), (14, None)],
        "kw int, m double",
    )
    assert [r[0] for r in values(df, tags.is_imbh("kw", "m"))] == [
        False, True, False, False, False, False,
    ]
    ids = spark.createDataFrame([(100, 20)], "a long, b long")
    assert values(ids, tags.pair_key("a", "b"), tags.pair_key_text("a", "b")) == [
        ("20-100", "100-20")
    ]


def test_existing_tags_stay_true(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 1.0, 1.0, True), (13, 1.0, 1.0, 1.0, False), (1, 1.0, 30.0, 60.0, False)],
        "kw int, mass_msun double, r_pc double, speed_kms double, tag_ns boolean",
    )
    got = values(tags.tag_singles(df), "tag_ns", "tag_high_velocity_halo_star", "is_funny")
    assert got == [(True, False, False), (True, False, True), (False, True, True)]


def test_orbit_elements_of_a_known_orbit(spark):
    """A state vector built from elements gives the elements back."""
    a, e, inc, node, peri, mu = 2.0, 0.3, 0.5, 1.2, 2.5, 4.0
    co, so, ci, si, cw, sw = (f(x) for x in (node, inc, peri) for f in (math.cos, math.sin))
    rot = np.array(
        [
            [co * cw - so * sw * ci, -co * sw - so * cw * ci, so * si],
            [so * cw + co * sw * ci, -so * sw + co * cw * ci, -co * si],
            [sw * si, cw * si, ci],
        ]
    )
    p, nu = a * (1 - e * e), 0.7
    r = rot @ (p / (1 + e * math.cos(nu)) * np.array([math.cos(nu), math.sin(nu), 0]))
    v = rot @ (math.sqrt(mu / p) * np.array([-math.sin(nu), e + math.cos(nu), 0]))
    df = spark.createDataFrame(
        [tuple(float(x) for x in (*r, *v))], "x double, y double, z double, u double, v double, w double"
    )
    el = geo.orbit_elements(geo.vec("x", "y", "z"), geo.vec("u", "v", "w"), F.lit(mu))
    got = values(df, *el.values())[0]
    assert got == pytest.approx((a, e, inc, node, peri))


def test_orbit_points_close_and_have_the_right_apsides(spark):
    df = spark.createDataFrame([(2.0, 0.5)], "a double, e double")
    zero = F.lit(0.0)
    pts = values(df, geo.orbit_points_xy("a", "e", zero, zero, zero, n=601))[0][0]
    assert len(pts) == 601
    assert (pts[0]["x"], pts[0]["y"]) == pytest.approx((1.0, 0.0))
    assert pts[300]["x"] == pytest.approx(-3.0)
    assert (pts[-1]["x"], pts[-1]["y"]) == pytest.approx((1.0, 0.0), abs=1e-9)


def test_two_body_geometry(spark):
    df = spark.createDataFrame(
        [(3.0, 1.0, 4.0), (0.0, 0.0, 4.0)], "m1 double, m2 double, x double"
    )
    first, second = geo.two_body_offsets("m1", "m2", geo.vec("x", F.lit(0.0), F.lit(0.0)))
    a1, a2 = geo.member_orbits(F.lit(8.0), "m1", "m2")
    assert values(df, first[0], second[0], a1, a2) == [(-1.0, 3.0, 2.0, 6.0), (0.0, 0.0, 0.0, 0.0)]


def test_milky_way_potential_anchors(spark):
    """Published values of the potential at 8 and 5 kpc in the disk plane."""
    df = spark.createDataFrame([(8.0, 0.0), (5.0, 0.0)], "r double, z double")
    got = [r[0] for r in values(df, galactic.mw_potential("r", "z"))]
    assert got == pytest.approx([-66470.17, -90006.34], abs=0.01)


def test_display_mappings(spark):
    df = spark.createDataFrame([(0.01,), (0.1,), (100.0,), (500.0,)], "m double")
    got = [r[0] for r in values(df, display.mass_radius("m"))]
    assert got == pytest.approx([0.12, 0.12, 0.85, 0.85])
    with pytest.raises(ValueError):
        display.mass_radius("m", scale="cube")
    sizes = spark.createDataFrame([(0.0004,), (2000.0,), (1e-9,)], "r double")
    assert [r[0] for r in values(sizes, display.marker_size("r"))] == pytest.approx(
        [10.0, 10000.0, 10.0]
    )
    hot = spark.createDataFrame([(3000.0,), (30000.0,)], "t double")
    cool, blue = [r[0] for r in values(hot, display.teff_rgb("t"))]
    assert cool["r"] == pytest.approx(1.0) and cool["b"] < 0.6
    assert blue["b"] == pytest.approx(1.0) and blue["r"] < 0.8


def test_colours_are_those_of_the_spectrum(spark):
    """The interpolation table against the integral, between its knots, at its ends and beyond."""
    kelvin = np.exp(np.linspace(np.log(600.0), np.log(9e5), 4001))
    x, y = display.blackbody_chromaticity(kelvin)
    linear = np.clip(np.array([x, y, 1 - x - y]).T @ display.XYZ_TO_RGB.T, 0.0, None)
    linear /= linear.max(axis=1, keepdims=True)
    want = np.where(linear <= 0.0031308, 12.92 * linear, 1.055 * linear ** (1 / 2.4) - 0.055)
    df = spark.createDataFrame([(float(t),) for t in kelvin], "t double")
    got = np.array([tuple(r[0]) for r in values(df, display.teff_rgb("t"))])
    assert np.abs(got - want).max() < 1e-7
    ends = spark.createDataFrame([(1.0,), (500.0,), (1e7,), (1e6,), (None,)], "t double")
    low, at_low, high, at_high, none = [r[0] for r in values(ends, display.teff_rgb("t"))]
    assert low == at_low and high == at_high and none is None


def test_numeric_helpers(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-2.5,)], "x double")
    assert [r[0] for r in values(df, round_id("x"))] == [2, 4, -2]
    t = spark.createDataFrame([(0.0,), (0.3,), (0.1 + 0.2,), (0.35,)], "t double")
    assert [r[0] for r in values(t, on_grid("t", 0.1))] == [True, True, True, False]
    assert [r[0] for r in values(t, on_grid("t", None))] == [True] * 4
    rng = np.random.default_rng(1)
    x = np.sort(np.concatenate([rng.normal(size=200) * 10.0 ** rng.integers(-8, 8, 200), [0.0]]))
    v = spark.createDataFrame([(float(a),) for a in x], "v double")
    bins = [r[0] for r in values(v.orderBy("v"), order_bin("v"))]
    assert bins == sorted(bins)
