import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from starfold import constants as K
from starfold.operators import (
    backfill,
    binaries as pairs,
    compact,
    dedup,
    derived,
    galactic,
    history,
    imbh,
    lagrangian,
    snapshot,
    stats,
    triples,
)

SIM = {"simulation_id": "s"}


@pytest.fixture
def pilot(frame):
    scalars = frame(
        [("s", 5.0, 10.0, 3.0, 2.0, 0.5, 2.0, 8000.0, 10.0, -10.0, 200.0, 1.0, -1.0)],
        "simulation_id string, ttot double, tscale_myr double, n_single double, n_binary double, "
        "rc_nb double, rbar_pc double, rg_x_pc double, rg_y_pc double, rg_z_pc double, "
        "vg_x_kmps double, vg_y_kmps double, vg_z_kmps double",
    )
    singles = frame(
        {
            "simulation_id": ["s"] * 3, "ttot": [5.0] * 3, "object_id": [1, 2, 3],
            "kw": [1, 14, 10], "mass_msun": [1.0, 20.0, 0.6], "x_pc": [1.0, 2.0, 3.0],
            "y_pc": [0.0] * 3, "z_pc": [0.0] * 3, "vx_kms": [1.0, 2.0, 3.0],
            "vy_kms": [0.0] * 3, "vz_kms": [0.0] * 3, "r_pc": [1.0, 2.0, 3.0],
        }
    )
    bins = frame(
        {
            "simulation_id": ["s"] * 2, "ttot": [5.0] * 2, "object_id_1": [10, 20],
            "object_id_2": [11, 21], "cm_id": [100, 200], "kw_1": [13, 14], "kw_2": [1, 13],
            "mass_1_msun": [1.4, 15.0], "mass_2_msun": [1.0, 1.3], "cm_x_pc": [5.0, 7.0],
            "cm_y_pc": [0.0] * 2, "cm_z_pc": [0.0, 0.0], "cm_vx_kms": [0.0] * 2,
            "cm_vy_kms": [0.0] * 2, "cm_vz_kms": [0.0] * 2, "r_pc": [5.0, 7.5],
            "semi_major_axis_au": [10.0, 3.0], "eccentricity": [0.1, 0.2],
        }
    )
    return scalars, singles, bins


def test_snapshot_summary_pilot(pilot):
    scalars, singles, bins = pilot
    row = snapshot.snapshot_summary(scalars, singles, bins).first()
    assert (row["n_bh"], row["n_ns"], row["n_wd"]) == (2, 2, 1)
    assert row["total_mass_msun"] == pytest.approx(40.3)
    assert (row["core_radius_pc"], row["half_mass_radius_pc"]) == (1.0, 2.0)
    assert (row["time_myr"], row["n_singles"], row["n_binaries"]) == (50.0, 3, 2)


def test_snapshot_without_stars_is_zero(pilot):
    scalars, singles, bins = pilot
    row = snapshot.snapshot_summary(scalars, singles.limit(0), bins.limit(0)).first()
    assert (row["n_bh"], row["total_mass_msun"], row["half_mass_radius_pc"]) == (0, 0.0, 0.0)


def test_compact_history_pilot(pilot):
    scalars, singles, bins = pilot
    rows = compact.compact_object_history(singles, bins, scalars).collect()
    by = {r["object_id"]: r for r in rows}
    assert set(by) == {2, 3, 10, 20, 21}
    assert by[20]["companion_id"] == 21 and by[20]["companion_kw"] == 13
    assert by[2]["object_type"] == "BH" and by[3]["object_type"] == "WD"
    assert not by[2]["is_in_binary"] and by[2]["companion_id"] is None


def _random_stars(n=400, snaps=3):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame(rng.normal(size=(n, 6)), columns="x_pc y_pc z_pc vx_kms vy_kms vz_kms".split())
    pdf["ttot"] = rng.integers(0, snaps, n).astype(float)
    pdf["object_id"] = rng.permutation(n)
    pdf["mass_msun"] = rng.lognormal(0, 1, n)
    pdf["simulation_id"] = "s"
    return pdf


def _direct_region(part, inside):
    """Weighted means and dispersions on a mask, straight from their definitions."""
    m, v, x, r = (a[inside] for a in part)
    w = m / m.sum()
    mean = w @ v
    unit = np.divide(x, r[:, None], out=np.zeros_like(x), where=r[:, None] > 0)
    vr = (v * unit).sum(1)
    vt = np.sqrt(np.maximum((v**2).sum(1) - vr**2, 0))
    rot = np.linalg.norm(np.cross(x, v), axis=1) / r
    s2 = w @ ((v - mean) ** 2).sum(1)
    sr2 = w @ (vr - w @ vr) ** 2
    return {
        "rlagr": r.max(), "avmass": m.mean(), "nshell": len(m), "vx": mean[0], "vy": mean[1],
        "vz": mean[2], "v": w @ np.linalg.norm(v, axis=1), "vr": w @ vr, "vt": w @ vt,
        "sigma2": s2, "sigma_r2": sr2, "sigma_t2": max(s2 - sr2, 0), "vrot": w @ rot,
    }


def test_lagrangian_profile_against_direct_sums(spark):
    pdf = _random_stars()
    scalars = spark.createDataFrame(
        [("s", float(t), 0.3, 2.0) for t in range(3)],
        "simulation_id string, ttot double, rc_nb double, rbar_pc double",
    )
    got = lagrangian.lagrangian_profile(spark.createDataFrame(pdf), scalars).toPandas()
    assert len(got) == 3 * 19
    for t, part in pdf.groupby("ttot"):
        x = part[["x_pc", "y_pc", "z_pc"]].to_numpy()
        v = part[["vx_kms", "vy_kms", "vz_kms"]].to_numpy()
        m = part["mass_msun"].to_numpy()
        r = np.linalg.norm(x, axis=1)
        v = v - (m @ v) / m.sum()
        order = np.argsort(r, kind="stable")
        m, v, x, r = m[order], v[order], x[order], r[order]
        cum = np.cumsum(m)
        for suffix in lagrangian.SUFFIXES:
            if suffix == "<RC":
                inside = r <= 0.6
            else:
                last = min(int(np.searchsorted(cum, m.sum() * float(suffix))), len(m) - 1)
                inside = np.arange(len(m)) <= last
            want = _direct_region((m, v, x, r), inside)
            row = got[(got.ttot == t) & (got.suffix == suffix)].iloc[0]
            for metric, value in want.items():
                assert row[metric] == pytest.approx(value, abs=1e-9), (t, suffix, metric)


def test_empty_core_is_undefined(spark):
    pdf = _random_stars(50, 1)
    scalars = spark.createDataFrame(
        [("s", 0.0, 0.0, 1.0)], "simulation_id string, ttot double, rc_nb double, rbar_pc double"
    )
    rows = lagrangian.lagrangian_profile(spark.createDataFrame(pdf), scalars)
    core = rows.where("suffix = '<RC'").first()
    assert core["nshell"] == 0 and core["rlagr"] is None and core["sigma2"] is None


def test_profile_long_labels_and_sigma(spark):
    pdf = _random_stars(60, 1)
    scalars = spark.createDataFrame(
        [("s", 0.0, 1.0, 1.0)], "simulation_id string, ttot double, rc_nb double, rbar_pc double"
    )
    profile = lagrangian.lagrangian_profile(spark.createDataFrame(pdf), scalars)
    long = lagrangian.profile_long(profile).toPandas()
    assert len(long) == 19 * 16
    labels = set(long["percent"])
    assert {"<RC", "0.1%", "0.3%", "1%", "50%", "95%", "100%"} <= labels
    at = long[long.percent == "50%"].set_index("metric")["value"]
    assert at["sigma"] == pytest.approx(math.sqrt(at["sigma2"]))
    whole = lagrangian.initial_total_mass(lagrangian.profile_long(profile), "ttot").first()
    assert whole["initial_total_mass_msun"] == pytest.approx(pdf["mass_msun"].sum())
    wide = lagrangian.profile_wide(profile)
    assert wide.count() == 1 and "rlagr5.00E-01" in wide.columns


def _binaries(frame, rows):
    return frame(
        [("s", *r) for r in rows],
        "simulation_id string, ttot double, object_id_1 long, object_id_2 long, kw_1 int, kw_2 int",
    )


def _scalars(frame, times, tscale=2.0):
    return frame(
        [("s", float(t), tscale) for t in times], "simulation_id string, ttot double, tscale_myr double"
    )


def test_compact_summary_first_and_last(frame):
    bins = _binaries(
        frame,
        [
            (1.0, 2, 1, 14, 14), (2.0, 1, 2, 14, 13), (0.0, 5, 6, 13, 1),
            (3.0, 5, 6, 13, 10), (1.0, 7, 8, 13, 10), (0.0, 11, 12, 14, 1),
        ],
    )
    hits = compact.compact_binary_hits(bins, _scalars(frame, range(4)))
    rows = {(r["category"], r["bin_name1"]): r for r in compact.compact_binary_summary(hits).collect()}
    gw = rows["gw_source", 1]
    assert (gw["first_ttot"], gw["last_ttot"], gw["n_snapshots_seen_in_category"]) == (1.0, 2.0, 2)
    assert gw["first_stellar_type"] == "BH-BH" and gw["last_stellar_type"] == "BH-NS"
    assert rows["pulsar", 5]["last_kw2"] == 10 and rows["xray_binary", 5]["last_ttot"] == 0.0
    assert gw["last_time_myr"] == 4.0


def test_primordial_and_b_type(frame):
    cols = (
        "simulation_id string, ttot double, object_id_1 long, object_id_2 long, kw_1 int, kw_2 int, "
        "teff_1_k double, teff_2_k double, mass_1_msun double, mass_2_msun double"
    )
    rows = [
        ("s", 0.0, 2, 1, 1, 1, 10500.0, 5000.0, 2.75, 1.0),
        ("s", 0.0, 9, 10, 1, 1, 31500.0, 20000.0, 17.7, 5.0),
        ("s", 0.0, 3, 5, 1, 1, 10499.0, 5000.0, 5.0, 1.0),
        ("s", 1.0, 1, 2, 1, 2, 15000.0, 15000.0, 5.0, 5.0),
        ("s", 1.0, 20, 21, 1, 1, 15000.0, 1.0, 5.0, 1.0),
    ]
    bins = frame(rows, cols)
    primordial = pairs.primordial_binaries(bins)
    assert {r["primordial_pair_key"] for r in primordial.collect()} == {"1-2", "9-10"}
    found = pairs.b_type_binaries(bins, primordial).collect()
    got = {(r["ttot"], r["b_type_pair_key"]): (r["b_type_member_count"], r["is_primordial_binary"]) for r in found}
    assert got == {
        (0.0, "1-2"): (1, True), (0.0, "9-10"): (2, True), (1.0, "1-2"): (1, True),
        (1.0, "20-21"): (1, False),
    }


def test_energetics_join_keys_and_missing_scalars(frame):
    bins = frame(
        [(0.0, 1, 10.0, 5.0, 1.0), (0.0, 0, 1.0, 1.0, 1.0), (0.0, -9, 1e-5, 1e-5, 1000.0)],
        "ttot double, bin_label int, mass_1_msun double, mass_2_msun double, semi_major_axis_au double",
    )
    scalars = frame(
        [("s", 0.0, 1.0, 1.0, 1.0, 0.01, 1000)],
        "simulation_id string, ttot double, zmbar_msun double, rbar_pc double, eclose_nb double, rc_nb double, nc long",
    )
    got = pairs.add_energetics(bins, scalars)
    assert [r["binary_class"] for r in got.orderBy("semi_major_axis_au", F.desc("mass_1_msun")).collect()] == [
        "hard", "soft", "temporary",
    ]
    assert pairs.drop_temporary(got).count() == 2
    assert pairs.drop_temporary(bins).count() == 3
    bare = pairs.add_energetics(bins, scalars.drop("nc"))
    assert bare.where("binary_class = 'temporary'").count() == 0


def test_drop_temporary_keeps_missing_class(frame):
    df = frame([("hard",), (None,), ("temporary",)], "binary_class string")
    assert pairs.drop_temporary(df).count() == 2


def _history_inputs(frame):
    singles = frame(
        [("s", 0.0, 1000, 1, 1.0), ("s", 1.0, 1000, 2, 0.9), ("s", 0.0, 7, 1, 3.0)],
        "simulation_id string, ttot double, object_id long, kw int, mass_msun double",
    )
    bins = frame(
        [("s", 2.0, 1000, 2000, 5.0, 0.1, 1), ("s", 0.0, 3000, 4000, 6.0, 0.2, 2),
         ("s", 3.0, 1000, 1000, 6.0, 0.2, 3)],
        "simulation_id string, ttot double, object_id_1 long, object_id_2 long, "
        "semi_major_axis_au double, eccentricity double, cm_id long",
    )
    return singles, bins


def test_history_full_outer(frame):
    singles, bins = _history_inputs(frame)
    rows = history.particle_history(singles, bins, raw_state=True)
    rows = rows.where("object_id = 1000").orderBy("ttot").collect()
    assert [(r["ttot"], r["state"], r["companion_id"]) for r in rows] == [
        (0.0, "single", None), (1.0, "single", None), (2.0, "binary", 2000), (3.0, "binary", 1000),
    ]
    assert [r["state_raw"] for r in rows] == [None, None, "binary", "binary"]
    alone = history.particle_history(singles, bins, raw_state=True).where("object_id = 7").first()
    assert alone["state_raw"] == "single"
    wanted = frame([("s", 7)], "simulation_id string, object_id long")
    assert history.particle_history(singles, bins, wanted).count() == 1


def test_particle_summary(frame):
    singles, bins = _history_inputs(frame)
    rows = history.particle_summary(history.particle_history(singles, bins))
    row = rows.where("object_id = 1000").first()
    assert (row["total_snapshots"], row["single_count"], row["binary_count"]) == (4, 2, 2)
    assert (row["initial_mass_msun"], row["final_mass_msun"]) == (1.0, 0.9)
    assert row["stellar_types"] == [1, 2]


def _times(frame, times):
    return frame([("s", 1, float(t)) for t in times], "simulation_id string, object_id long, ttot double")


def test_history_filters(frame):
    h = _times(frame, [0, 1, 2.5, 3, 7.5, 8, 20])
    pick = lambda df: sorted(r["ttot"] for r in df.collect())
    assert pick(history.filter_history(h, "all")) == [0, 1, 2.5, 3, 7.5, 8, 20]
    assert pick(history.filter_history(h, 2.0)) == [2.5]
    assert pick(history.filter_history(h, (1, 3))) == [1, 2.5, 3]
    times = np.array([0, 1, 2.5, 3, 7.5, 8, 20])
    at = np.searchsorted(times, np.arange(0, 20 + 3, 3.0))
    want = sorted(set(times[at[at < len(times)]]))
    assert pick(history.filter_history(h, "sample", 3.0)) == want


def test_early_stop_after_five_missing_files(frame):
    files = frame([("s", float(i), i) for i in range(1, 21)], "simulation_id string, ttot double, file_index long")
    kept = lambda times: sorted(r["ttot"] for r in history.stop_after_gap(_times(frame, times), files).collect())
    assert kept([1, 2, 6, 11]) == [1, 2, 6, 11]
    assert kept([1, 2, 8, 9]) == [1, 2]
    assert kept([6, 7]) == []
    assert kept([5, 6]) == [5, 6]


def test_merge_history_prefers_new(frame):
    cols = "simulation_id string, object_id long, ttot double, m double"
    old = frame([("s", 1, 0.0, 1.0), ("s", 1, 1.0, 1.0)], cols)
    new = frame([("s", 1, 1.0, 2.0), ("s", 1, 2.0, 2.0)], cols)
    merged = history.merge_history(old, new)
    assert sorted((r["ttot"], r["m"]) for r in merged.collect()) == [(0.0, 1.0), (1.0, 2.0), (2.0, 2.0)]
    assert history.resume_points(merged).first()["skip_until"] == 2.0


def test_evolution_path_epochs(frame):
    singles, bins = _history_inputs(frame)
    path = history.evolution_path(history.particle_history(singles, bins))
    epochs = path.where("object_id = 1000").first()["epochs"]
    assert [e["ttot"] for e in epochs] == [0.0, 1.0, 2.0, 3.0]
    assert epochs[2]["pair"]["companion_id"] == 2000


@pytest.mark.parametrize("cell_stars", [1_000_000, 5])
def test_triples_against_brute_force(spark, cell_stars):
    """All stars near every pair, also when crowded cells are split into salts."""
    rng = np.random.default_rng(2)
    n, m = 300, 40
    s = pd.DataFrame(rng.normal(size=(n, 6)), columns="x_pc y_pc z_pc vx_kms vy_kms vz_kms".split())
    s = s.assign(simulation_id="s", ttot=0.0, object_id=np.arange(n), kw=1, mass_msun=rng.random(n) + 0.5)
    s[["vx_kms", "vy_kms", "vz_kms"]] *= 0.02
    b = pd.DataFrame(rng.normal(size=(m, 6)), columns="cm_x_pc cm_y_pc cm_z_pc cm_vx_kms cm_vy_kms cm_vz_kms".split())
    b[["cm_vx_kms", "cm_vy_kms", "cm_vz_kms"]] *= 0.02
    b = b.assign(
        simulation_id="s", ttot=0.0, object_id_1=np.arange(m), object_id_2=np.arange(m) + 1000, cm_id=np.arange(m),
        kw_1=1, kw_2=1, mass_1_msun=2.0, mass_2_msun=1.0, eccentricity=0.1,
        semi_major_axis_au=10.0 ** rng.uniform(0, 3.5, m),
    )
    cand = triples.triple_candidates(spark.createDataFrame(s), spark.createDataFrame(b), cell_stars)
    cand.cache()
    near, bound = set(), set()
    for _, p in b.iterrows():
        d = np.linalg.norm(s[["x_pc", "y_pc", "z_pc"]].to_numpy() - p[["cm_x_pc", "cm_y_pc", "cm_z_pc"]].to_numpy(float), axis=1)
        v = np.linalg.norm(s[["vx_kms", "vy_kms", "vz_kms"]].to_numpy() - p[["cm_vx_kms", "cm_vy_kms", "cm_vz_kms"]].to_numpy(float), axis=1)
        m3 = s["mass_msun"].to_numpy()
        e = 0.5 * 3 * m3 / (3 + m3) * v**2 - K.G_PC_KMS2_MSUN * 3 * m3 / d
        ok = (d <= p["semi_major_axis_au"] / K.PC_TO_AU * 1000) & (s["object_id"] != p["object_id_1"])
        near |= {(p["cm_id"], i) for i in s["object_id"][ok]}
        bound |= {(p["cm_id"], i) for i in s["object_id"][ok & (e < 0)]}
    assert {(r[0], r[1]) for r in cand.select("cm_id", "third_id").collect()} == near
    assert cand.count() == len(near)
    got = triples.bound_triples(cand)
    assert {(r[0], r[1]) for r in got.select("cm_id", "third_id").collect()} == bound
    assert 0 < len(bound) < len(near)


def _fold(rows):
    gen, out = {}, {}
    for _, product, p1, p2 in sorted(rows):
        gen[product] = max(gen.get(product, 0), 1 + max(gen.get(p1, 0), gen.get(p2, 0)))
        out[product] = gen[product]
    return out


@pytest.mark.parametrize("block", [3, 10, 1000])
def test_generations_do_not_depend_on_block_size(frame, block):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(60):
        p1, p2 = rng.integers(0, 12, 2)
        rows.append((i, int(max(p1, p2)), int(p1), int(p2)))
    events = frame(
        [("s", i, float(i // 2), product, a, b) for i, product, a, b in rows],
        "simulation_id string, seq long, ttot double, product_name long, parent_name_1 long, parent_name_2 long",
    )
    got = {r["product_name"]: r["generation"] for r in imbh.merger_generations(events, block).collect()}
    assert got == _fold(rows)


def test_many_events_at_one_time_settle(spark):
    events = spark.range(20_000).selectExpr(
        "'s' AS simulation_id", "1.0D AS ttot", "id AS seq", "id DIV 2 AS product_name",
        "id DIV 2 AS parent_name_1", "id + 1000000 AS parent_name_2")
    got = imbh.merger_generations(events, 5000)
    assert got.groupBy("generation").count().collect() == [(2, 10_000)]


def test_no_mergers_no_generations(frame):
    empty = frame(
        [], "simulation_id string, seq long, ttot double, product_name long, parent_name_1 long, parent_name_2 long"
    )
    assert imbh.merger_generations(empty).count() == 0


def test_merger_survivor_rules(frame):
    events = frame(
        [("s", 1, 1.0, 1, 2, 14, 14, 80.0, 90.0), ("s", 2, 2.0, 3, 4, 14, 1, 150.0, 150.0),
         ("s", 3, 3.0, 5, 6, 1, 1, None, 3.0), ("s", 4, 3.0, 9, 8, 1, 1, 1.0, 2.0)],
        "simulation_id string, seq long, ttot double, parent_name_1 long, parent_name_2 long, "
        "parent_kw_1 int, parent_kw_2 int, parent_mass_1_msun double, parent_mass_2_msun double",
    )
    known = frame([("s", 5)], "simulation_id string, object_name long")
    rows = {r["seq"]: r for r in imbh.imbh_mergers(events, known).collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[1]["product_name"] == 2 and rows[1]["is_imbh_product"] and not rows[1]["has_imbh_parent"]
    assert rows[2]["product_name"] == 3 and rows[2]["equal_mass_survivor_fallback"]
    assert rows[3]["product_name"] == 6 and rows[3]["product_mass_msun"] == 3.0 and rows[3]["has_imbh_parent"]


def test_forward_only_example(frame):
    times = [1.0, 2.1, 3.2, 4.3, 5.7, 3.5, 4.6, 5.9, 4.7, 4.8, 7.1]
    df = frame([("s", i, t) for i, t in enumerate(times)], "simulation_id string, seq long, t double")
    for width in (2, 3, 65_536):
        kept = dedup.forward_only(df, ["simulation_id"], "t", "seq", chunk_width=width)
        assert sorted(r["t"] for r in kept.collect()) == [1.0, 2.1, 3.2, 4.3, 5.7, 5.9, 7.1]


def test_keep_last_and_compat_rule(frame):
    df = frame([(i, t) for i, t in enumerate([1.0, 2.0, 2.0, 2.0, 3.0])], "i long, t double")
    assert sorted(r["i"] for r in dedup.keep_last(df, ["t"], "i").collect()) == [0, 3, 4]
    assert sorted(r["i"] for r in dedup.keep_all_but_last(df, ["t"], "i").collect()) == [0, 1, 2, 4]


def test_step_winner_is_newest_then_greatest_path(frame):
    steps = frame(
        [("s", 1.0, 10.0, "a"), ("s", 1.0, 20.0, "b"), ("s", 2.0, 5.0, "a"), ("s", 2.0, 5.0, "b"), ("s", 3.0, 1.0, "a")],
        "simulation_id string, ttot double, mtime double, source_hdf5_path string",
    )
    win = {r["ttot"]: r["source_hdf5_path"] for r in dedup.step_winners(steps).collect()}
    assert win == {1.0: "b", 2.0: "b", 3.0: "a"}
    lost = {(r["source_hdf5_path"], r["ttot"]) for r in dedup.step_losers(steps).collect()}
    assert lost == {("a", 1.0), ("a", 2.0)}


def test_replace_snapshots_drops_rescanned_empty_ones(frame):
    cols = "simulation_id string, ttot double, v long"
    old = frame([("s", 0.0, 1), ("s", 1.0, 1), ("s", 2.0, 1)], cols)
    new = frame([("s", 1.0, 2)], cols)
    scanned = frame([("s", 1.0, 0), ("s", 2.0, 0)], cols)
    got = dedup.replace_snapshots(old, new, scanned).collect()
    assert sorted((r["ttot"], r["v"]) for r in got) == [(0.0, 1), (1.0, 2)]
    got = dedup.upsert(old, new).collect()
    assert sorted((r["ttot"], r["v"]) for r in got) == [(0.0, 1), (1.0, 2), (2.0, 1)]


def test_galactic_angular_momentum(frame):
    stars = frame(
        [("s", 0.0, 1, 2.0, 1000.0, 0.0, 0.0, 0.0, 0.0, 0.0), ("s", 0.0, 2, 3.0, 0.0, 2000.0, 0.0, 0.0, 0.0, 0.0)],
        "simulation_id string, ttot double, object_id long, mass_msun double, x_pc double, y_pc double, z_pc double, "
        "vx_kms double, vy_kms double, vz_kms double",
    )
    scalars = frame(
        [("s", 0.0, 1.0, 1.0, 0.0, 0.0, 0.0, 1.0, 2.0, 3.0)],
        "simulation_id string, ttot double, rbar_pc double, vstar_kms double, rg_x_pc double, rg_y_pc double, "
        "rg_z_pc double, vg_x_kmps double, vg_y_kmps double, vg_z_kmps double",
    )
    rows = galactic.star_energies(stars, scalars).orderBy("object_id").collect()
    assert [r["l_z"] for r in rows] == pytest.approx([4.0, -6.0])
    assert rows[0]["e_kin"] == pytest.approx(14.0)
    assert rows[0]["e_gal"] == pytest.approx(2 * (7.0 + rows[0]["e_pot_specific"]))


def test_orbital_frame_skips_degenerate_snapshots(frame):
    stars = frame(
        [("s", 0.0, 1, 1.0, 2.0, 3.0), ("s", 1.0, 1, 1.0, 2.0, 3.0)],
        "simulation_id string, ttot double, object_id long, x_pc double, y_pc double, z_pc double",
    )
    scalars = frame(
        [("s", 0.0, 8.0, 0.0, 0.0, 0.0, 2.0, 0.0), ("s", 1.0, 8.0, 0.0, 0.0, 1.0, 0.0, 0.0)],
        "simulation_id string, ttot double, rg_x_pc double, rg_y_pc double, rg_z_pc double, "
        "vg_x_kmps double, vg_y_kmps double, vg_z_kmps double",
    )
    rows = galactic.orbital_frame_positions(stars, scalars).collect()
    assert len(rows) == 1
    assert (rows[0]["x_r_pc"], rows[0]["x_t_pc"], rows[0]["x_l_pc"]) == (1.0, 2.0, 3.0)


def test_centre_round_trip_and_display_clip(frame):
    stars = frame([("s", 0.0, 13, 9.0, 5.0e6, 1.0, 2.0, 3.0), ("s", 0.0, 1, 9.0, 5000.0, 1.0, 2.0, 3.0)],
                  "simulation_id string, ttot double, kw int, luminosity_lsun double, teff_k double, x double, y double, z double")
    scalars = frame([("s", 0.0, 0.1, 0.2, 0.3, 2.0)],
                    "simulation_id string, ttot double, rdens_x_nb double, rdens_y_nb double, rdens_z_nb double, rbar_pc double")
    names = {"x": "xc", "y": "yc", "z": "zc"}
    moved = derived.centred(stars, scalars, names)
    assert moved.first()["xc"] == pytest.approx(0.8)
    back = derived.uncentred(moved.drop("x", "y", "z"), scalars, names).first()
    assert (back["x"], back["y"], back["z"]) == pytest.approx((1.0, 2.0, 3.0))
    shown = stars.select(
        derived.displayed(F.col("kw"), "luminosity_lsun", K.DISPLAY_LIMITS["L*"], flat=True).alias("l"),
        derived.displayed(F.col("kw"), "teff_k", K.DISPLAY_LIMITS["Teff*"], flat=False).alias("t"),
    ).collect()
    assert shown[0]["l"] == pytest.approx(1.08e-5) and shown[0]["t"] == 1050000.0
    assert (shown[1]["l"], shown[1]["t"]) == (9.0, 5000.0)


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"k": 0, "a": rng.lognormal(0, 2, 500), "b": rng.normal(size=500)})
    got = stats.histogram(spark.createDataFrame(pdf), ["a", "b"], keys=["k"], bins=10, log=[True, False]).toPandas()
    want, _, _ = np.histogram2d(np.log10(pdf["a"]), pdf["b"], bins=10)
    mine = np.zeros((10, 10))
    mine[got["bin_0"], got["bin_1"]] = got["n"]
    assert np.array_equal(mine, want)


def test_percentile_limits_keep_the_point_in_view(spark):
    pdf = pd.DataFrame({"simulation_id": "s", "ttot": 0.0, "a": np.arange(101.0)})
    point = spark.createDataFrame([("s", 0.0, 200.0)], "simulation_id string, ttot double, a double")
    row = stats.percentile_limits(spark.createDataFrame(pdf), ["a"], percents=(10, 90), point=point).first()
    assert (row["a_low"], row["a_high"]) == pytest.approx((10.0, 204.0))


def test_nzero_inference(frame):
    cols = "simulation_id string, ttot double, n long"
    assert backfill.infer_nzero(frame([("s", 0.0, 500), ("s", 1.0, 400)], cols)).first()["nzero"] == 500
    with pytest.raises(Exception, match="NZERO"):
        backfill.infer_nzero(frame([("s", 1.0, 400)], cols)).collect()
