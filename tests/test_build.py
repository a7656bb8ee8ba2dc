import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import fake_h5  # noqa: E402

from starfold.cli import parse_nzero  # noqa: E402
from starfold.plans.build import (  # noqa: E402
    FEATURES, Builder, Feature, Job, ScanOptions, expand_features, files_to_process, raw_tables,
    stellar_type_feature,
)
from starfold.plans.histories import read_history, update_histories  # noqa: E402
from starfold.plans.maintain import (  # noqa: E402
    backfill_store, nzero_of, once, validate_backfill,
)
from starfold.plans.store import FeatureStore, connect, load_feature  # noqa: E402
from starfold.schema.registry import SCALAR_NAMES, TABLES  # noqa: E402
from starfold.streaming import ingest  # noqa: E402

OPENER = "fake_h5:open_file"
NOW = 4e9


def step(ttot, n=6, pairs=3, label=True, mass=1.0, triple=True):
    slots = np.zeros(100, dtype="float32")
    given = {"TTOT": ttot, "RBAR": 2.0, "ZMBAR": 100.0, "TSCALE": 3.0, "VSTAR": 4.0, "RDENS(1)": 0.1, "RC": 0.5,
             "NC": 10.0, "ECLOSE": 1.0, "N": 1000.0, "TIDAL(1)": 0.5, "N_SINGLE": n, "N_BINARY": pairs, "RG(1)": 8.0, "VG(2)": 2.0}
    for name, value in given.items():
        slots[SCALAR_NAMES.index(name)] = value
    data = {"000 Scalars": slots}

    def fill(table, first, count, special):
        number = first
        for c in TABLES[f"snapshot_{table}"][1]:
            if c.raw:
                kind = "int32" if c.dtype.startswith("int") else "float32"
                value = special.get(c.raw, np.zeros(count))
                if not (c.raw == "Bin Label" and not label):
                    data[f"{number:03d} {c.raw}"] = np.asarray(value).astype(kind)
                number += 1

    fill("singles", 1, n, {"Name": np.arange(n, 0, -1), "KW": [14, 13, 10, 1, 1, 1][:n], "M": np.full(n, 150.0 * mass),
                           "X1": np.arange(n) + 0.5, "L*": np.full(n, 999.0)})
    fill("binaries", 101, pairs, {"Bin Name1": [11, 21, 31][:pairs], "Bin Name2": [12, 25, 32][:pairs], "Bin cm Name": [1011, 40, -5][:pairs],
                                  "Bin KW1": [14, 1, 13][:pairs], "Bin KW2": [14, 1, 1][:pairs], "Bin M1*": np.full(pairs, 10.0), "Bin M2*": np.full(pairs, 5.0),
                                  "Bin A[au]": np.full(pairs, 1.0), "Bin ECC": np.full(pairs, 0.5), "Bin Label": [1, 0, -1][:pairs], "Bin G": [0.5, 0.5, 0.5][:pairs]})
    if triple:
        fill("mergers", 201, 1, {"Mer NAM1": [5], "Mer NAM2": [6], "Mer NAM3": [7]})
    return {"Time": np.float32(ttot), "N_STAR": np.int32(n)}, data


@pytest.fixture
def world(spark, tmp_path):
    """A simulation with two run directories that both wrote ttot 2."""
    spark.sparkContext.addPyFile(fake_h5.__file__)
    root = tmp_path / "sim"
    for run in ("r1", "r2"):
        os.makedirs(root / run)
    fake_h5.write_file(root / "r1" / "snap.40_0.h5part", {"Step#0": step(0.0), "Step#1": step(1.0), "Step#10": step(1.0, mass=9.0)})
    fake_h5.write_file(root / "r1" / "snap.40_2.h5part", {"Step#0": step(2.0)})
    fake_h5.write_file(root / "r2" / "snap.40_3.h5part", {"Step#0": step(2.0, mass=2.0), "Step#1": step(3.0, label=False)})
    for i, f in enumerate(("r1/snap.40_0", "r1/snap.40_2", "r2/snap.40_3")):
        os.utime(root / f"{f}.h5part", (1000.0 + i, 1000.0 + i))
    store = FeatureStore(spark, str(tmp_path / "cache"), str(tmp_path / "lake"), ("s",))
    return root, store, Builder(store, {"s": str(root)}, opener=OPENER, now=lambda: NOW)


def build(builder, names, **options):
    opts = ScanOptions(**{"sample_every_nb_time": None, **options})
    for name in names:
        builder.add(Job("s", FEATURES[name], opts))
    builder.run()


def test_data_source_keeps_first_of_equal_times(spark, world):
    root, _, builder = world
    path = str(root / "r1" / "snap.40_0.h5part")
    rows = builder.raw("singles", [path])
    assert rows.count() == 12
    # 'Step#1' sorts before 'Step#10', so its ttot 1 wins
    assert {r["M"] for r in rows.where("TTOT = 1").collect()} == {150.0}
    assert [(r["TTOT"], r["N_STAR"]) for r in builder.raw("steps", [path]).orderBy("step_key").collect()] == [(0.0, 6), (1.0, 6), (1.0, 6)]


def test_lake_build_dedups_and_conserves(spark, world):
    root, store, builder = world
    build(builder, expand_features(["lake"]), checkpoint_every_files=2)
    singles = store.read("s", "snapshot_singles")
    assert singles.columns == [c.name for c in TABLES["snapshot_singles"][1]]
    counts = {r["ttot"]: r["count"] for r in singles.groupBy("ttot").count().collect()}
    assert counts == {0.0: 6, 1.0: 6, 2.0: 6, 3.0: 6}
    # the newer file is authoritative for ttot 2, in every table
    assert {r["mass_msun"] for r in singles.where("ttot = 2").collect()} == {300.0}
    for table in ("snapshot_scalars", "snapshot_binaries", "snapshot_mergers"):
        paths = {r[0] for r in store.read("s", table).where("ttot = 2").select("source_hdf5_path").collect()}
        assert paths == {str(root / "r2" / "snap.40_3.h5part")}
    star = singles.where("ttot = 0 AND object_id = 6").first()
    assert star["x_pc"] == pytest.approx(0.5 - 0.2, rel=1e-6) and star["time_myr"] == 0.0
    assert star["luminosity_lsun"] == 999.0
    labels = store.read("s", "snapshot_binaries").where("ttot = 3").select("bin_label").distinct().collect()
    assert [r[0] for r in labels] == [-9]


def test_incremental_build(spark, world):
    root, store, builder = world
    names = ["compact_object_history", "snapshot_summary", "galactic_orbit", "compact_binary_count"]
    build(builder, names)
    assert store.read("s", "snapshot_summary").count() == 4
    assert store.read("s", "compact_object_history").where("ttot = 0").count() == 3 + 3
    before = store.manifest("s", "snapshot_summary").count()
    build(builder, names)  # nothing new
    assert store.manifest("s", "snapshot_summary").count() == before == 3
    fake_h5.write_file(root / "r2" / "snap.40_4.h5part", {"Step#0": step(4.0)})
    os.utime(root / "r2" / "snap.40_4.h5part", (1010.0, 1010.0))
    build(builder, names)
    assert sorted(r["ttot"] for r in store.read("s", "snapshot_summary").collect()) == [0, 1, 2, 3, 4]
    # a changed file is read again and its snapshots replaced, once each
    fake_h5.write_file(root / "r2" / "snap.40_4.h5part", {"Step#0": step(4.0, mass=3.0)})
    os.utime(root / "r2" / "snap.40_4.h5part", (1020.0, 1020.0))
    build(builder, names)
    rows = store.read("s", "compact_object_history").where("ttot = 4 AND NOT is_in_binary")
    assert {r["mass_msun"] for r in rows.collect()} == {450.0} and rows.count() == 3
    build(builder, ["snapshot_summary"], exclude_bad_dirname=False)  # changed options rebuild
    assert store.read("s", "snapshot_summary").count() == 5


def test_other_features_and_sampling(spark, world):
    _, store, builder = world
    build(builder, ["current_lagrangian", "primordial_binary", "b_type_binary", "intermediate_mass_black_hole"])
    assert store.read("s", "current_lagrangian").count() == 4 * 19
    assert {r["primordial_pair_key"] for r in store.read("s", "primordial_binary").collect()} == {"11-12", "31-32"}
    assert store.read("s", "b_type_binary").count() == 0
    assert store.read("s", "intermediate_mass_black_hole").where("ttot = 0").count() == 1
    builder.add(Job("s", stellar_type_feature("NS"), ScanOptions(sample_every_nb_time=3.0)))
    builder.run()
    kept = store.read("s", "binary_stellar_type_13")
    assert {r["ttot"] for r in kept.collect()} == {0.0, 3.0}


def test_unreadable_file_is_skipped_when_allowed(spark, world):
    root, store, builder = world
    (root / "r1" / "snap.40_9.h5part").write_bytes(b"broken")
    os.utime(root / "r1" / "snap.40_9.h5part", (1005.0, 1005.0))
    with pytest.raises(Exception):
        build(builder, ["snapshot_scalars"])
    build(builder, ["snapshot_scalars"], skip_unreadable_files=True)
    assert store.read("s", "snapshot_scalars").count() == 4
    assert store.manifest("s", "snapshot_scalars").count() == 4


def test_lake_first_equals_source(spark, world):
    root, store, builder = world
    path = str(root / "r1" / "snap.40_0.h5part")
    columns = {"singles": ["Name", "X1", "M", "KW"], "scalars": None}
    direct = raw_tables(builder, None, path, columns)["singles"]
    assert direct.columns == ["Name", "X1", "M", "KW", "TTOT"]
    build(builder, expand_features(["lake"]))
    served = raw_tables(builder, "s", path, columns)["singles"]
    assert served.columns == direct.columns
    read = lambda df: sorted((r["Name"], round(r["X1"], 5), r["M"], r["KW"], r["TTOT"]) for r in df.collect())
    assert read(served) == read(direct)


def test_query_layer(spark, world):
    _, store, builder = world
    with pytest.raises(FileNotFoundError, match="analyze"):
        load_feature(store, "s", "compact_object_history")
    build(builder, ["compact_object_history"])
    with pytest.raises(ValueError, match="nope"):
        load_feature(store, "s", "compact_object_history", columns=["nope"])
    got = load_feature(store, "s", "compact_object_history", columns=["ttot", "object_id"],
                       where="kw = ? AND ttot >= ?", params=[14, 1.0])
    assert got.columns == ["ttot", "object_id"] and got.count() == 3 * 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ttot,1.0)" in plan and "mass_msun" not in plan
    assert connect(store, simulation_ids=["s", "other"]) == ["compact_object_history"]
    assert spark.sql("SELECT count(*) FROM compact_object_history WHERE object_type = 'NS'").first()[0] == 8


def test_backfill_is_idempotent(spark, world):
    _, store, builder = world
    build(builder, expand_features(["lake"]))
    assert nzero_of(store, "s") == 1000
    dry = backfill_store(store, "s", 1000, dry_run=True).collect()
    assert [(r["unknown_before"], r["to_hard"], r["to_merger_or_hierarchical"], r["still_unknown"]) for r in dry] == [(3, 1, 1, 1)]
    backfill_store(store, "s", 1000)
    labels = lambda: sorted((r["object_id_1"], r["bin_label"]) for r in store.read("s", "snapshot_binaries").where("ttot = 3").collect())
    assert labels() == [(11, 1), (21, -9), (31, -1)]
    assert store.read("s", "snapshot_binaries").count() == 12
    again = backfill_store(store, "s", 1000).collect()
    assert [(r["unknown_before"], r["still_unknown"]) for r in again] == [(1, 1)]
    report = validate_backfill(store, "s", 1000)
    assert report["n_known"] == 11 and report["nzero_consistent"]


def test_once_and_histories(spark, world):
    _, store, builder = world
    with pytest.raises(FileNotFoundError):
        once(store, "s", "initial_total_mass", lambda: None, update=False)
    make = lambda v: lambda: spark.createDataFrame([(v,)], "m double")
    assert once(store, "s", "initial_total_mass", make(1.0)).first()["m"] == 1.0
    assert once(store, "s", "initial_total_mass", make(2.0)).first()["m"] == 1.0
    assert once(store, "s", "initial_total_mass", make(2.0), force=True).first()["m"] == 2.0
    build(builder, expand_features(["lake"]))
    tables = [store.read("s", f"snapshot_{n}") for n in ("singles", "binaries")]
    assert read_history(store, "s", 11) is None
    update_histories(store, "s", *[t.where("ttot < 2") for t in tables])
    update_histories(store, "s", *[t.where("ttot >= 1") for t in tables])
    rows = read_history(store, "s", 11).orderBy("ttot").collect()
    assert [(r["ttot"], r["state"]) for r in rows] == [(float(t), "binary") for t in range(4)]


def test_tail_rule(spark):
    catalog = spark.createDataFrame(
        [("a", 0.0, 1.0), ("b", 1.0, 1.0), ("c", 2.0, 9.0), ("d", 3.0, 1.0)], "path string, filename_time double, mtime double"
    )
    manifest = spark.createDataFrame([("a", 0.5, [0.0]), ("c", 1.0, [2.0])], "source_hdf5_path string, mtime double, ttot array<double>")
    pick = lambda **k: {r["path"] for r in files_to_process(catalog, manifest, **k).collect()}
    assert pick() == {"b", "c", "d"}
    assert pick(tail_only=False) == {"a", "b", "c", "d"}


def test_job_rules(world):
    _, _, builder = world
    assert expand_features(["pilot", "snapshot_summary"]) == ["compact_object_history", "snapshot_summary"]
    with pytest.raises(ValueError):
        expand_features(["nope"])
    with pytest.raises(ValueError):
        Feature("x", lambda t: None, kind="other")
    with pytest.raises(ValueError, match="twice"):
        build(builder, ["snapshot_summary", "snapshot_summary"])
    assert parse_nzero(["a=5"]) == {"a": 5}
    with pytest.raises(ValueError):
        parse_nzero(["a"])


def test_streamed_upsert(spark, tmp_path):
    landing, sink = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "simulation_id string, ttot double, v long"
    def deliver(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
    def run():
        stream = ingest.snapshot_stream(spark, landing, spark.createDataFrame([], schema).schema, 1)
        ingest.ingest(stream, sink, str(tmp_path / "cp")).awaitTermination()
    deliver([("s", 0.0, 1), ("s", 1.0, 1)])
    run()
    deliver([("s", 1.0, 2), ("s", 1.0, 3), ("s", 2.0, 2)])
    run()
    got = sorted((r["ttot"], r["v"]) for r in ingest.current_snapshots(spark, sink).collect())
    assert got == [(0.0, 1), (1.0, 2), (1.0, 3), (2.0, 2)]
    ingest.compact_batches(spark, sink, str(tmp_path / "clean"))
    assert spark.read.parquet(str(tmp_path / "clean")).count() == 4
    assert ingest.current_winners(spark, sink, "v").where("ttot = 1").first()["v"] == 3


def test_command_line(spark, world, tmp_path, capfd):
    import json

    from starfold.cli import main

    root, store, _ = world
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"paths": {
        "simulations": {"s": str(root)}, "analysis_cache_dir": store.cache_root, "lake_dir": store.lake_root,
    }}))
    config = ["--config", str(path)]
    assert main([*config, "analyze", "--simu", "s", "--features", "lake,pilot", "--opener", OPENER]) == 0
    assert store.read("s", "snapshot_singles").count() == 24
    assert store.read("s", "snapshot_summary").count() == 4
    assert main([*config, "backfill-bin-label", "--dry-run", "--nzero", "s=1000"]) == 0
    assert main([*config, "backfill-bin-label", "--validate"]) == 0
    assert main([*config, "preflight", "--opener", OPENER]) == 0
    out = capfd.readouterr().out
    assert "unknown_before" in out and "n_known" in out and "estimated_row_count" in out
    with pytest.raises(SystemExit):
        main([*config, "analyze", "--simu", "other"])


# ---------------------------------------------------------------------- stored tables over time


def touch(path, when):
    os.utime(path, (when, when))


def snapshots(store, feature):
    return {r["ttot"]: r["count"] for r in store.read("s", feature).groupBy("ttot").count().collect()}


LAKE_AND_SUMMARY = [*expand_features(["lake"]), "snapshot_summary", "compact_object_history"]


def test_late_overlap_replaces_the_stored_loser(spark, world):
    root, store, builder = world
    build(builder, LAKE_AND_SUMMARY)
    late = root / "r2" / "snap.40_5.h5part"
    fake_h5.write_file(late, {"Step#0": step(1.0, mass=4.0), "Step#1": step(5.0)})
    touch(late, 1010.0)
    build(builder, LAKE_AND_SUMMARY)
    assert snapshots(store, "snapshot_singles") == {0.0: 6, 1.0: 6, 2.0: 6, 3.0: 6, 5.0: 6}
    assert snapshots(store, "snapshot_scalars") == {t: 1 for t in (0.0, 1.0, 2.0, 3.0, 5.0)} == snapshots(store, "snapshot_summary")
    assert {r["mass_msun"] for r in store.read("s", "snapshot_singles").where("ttot = 1").collect()} == {600.0}
    os.remove(late)  # the former winner comes back when the file goes
    build(builder, LAKE_AND_SUMMARY)
    assert snapshots(store, "snapshot_singles") == {0.0: 6, 1.0: 6, 2.0: 6, 3.0: 6}
    assert {r["mass_msun"] for r in store.read("s", "snapshot_singles").where("ttot = 1").collect()} == {150.0}
    assert snapshots(store, "snapshot_summary") == {t: 1 for t in (0.0, 1.0, 2.0, 3.0)}


def test_changed_file_without_rows_loses_its_old_rows(spark, world):
    root, store, builder = world
    build(builder, LAKE_AND_SUMMARY)
    last = root / "r2" / "snap.40_3.h5part"
    fake_h5.write_file(last, {})
    touch(last, 1020.0)
    build(builder, LAKE_AND_SUMMARY)
    assert snapshots(store, "snapshot_singles") == {0.0: 6, 1.0: 6, 2.0: 6}
    assert {r["mass_msun"] for r in store.read("s", "snapshot_singles").where("ttot = 2").collect()} == {150.0}
    assert set(snapshots(store, "compact_object_history")) == set(snapshots(store, "snapshot_summary")) == {0.0, 1.0, 2.0}


@pytest.mark.parametrize("feature", ["snapshot_summary", "snapshot_singles"])
def test_stop_before_the_pointer_leaves_the_old_state(spark, world, monkeypatch, feature):
    root, store, builder = world
    build(builder, [feature])
    before = snapshots(store, feature)
    new = root / "r2" / "snap.40_4.h5part"
    fake_h5.write_file(new, {"Step#0": step(4.0)})
    touch(new, 1010.0)
    publish, stopped = FeatureStore.publish, []

    def stop(self, simulation_id, name, *args, **kwargs):
        if name == feature and not stopped:
            stopped.append(name)
            raise KeyboardInterrupt
        return publish(self, simulation_id, name, *args, **kwargs)

    monkeypatch.setattr(FeatureStore, "publish", stop)
    with pytest.raises(KeyboardInterrupt):
        build(builder, [feature])
    assert snapshots(store, feature) == before
    build(builder, [feature])
    assert snapshots(store, feature) == {**before, 4.0: before[0.0]}


def test_rebuild_keeps_the_old_rows_until_it_is_done(spark, world, monkeypatch):
    _, store, builder = world
    build(builder, ["snapshot_summary"])
    calls = []
    stage = FeatureStore.stage

    def second_fails(self, simulation_id, name, *args):
        calls.append(name)
        if calls.count("snapshot_summary") == 2:
            raise RuntimeError("stopped")
        return stage(self, simulation_id, name, *args)

    monkeypatch.setattr(FeatureStore, "stage", second_fails)
    with pytest.raises(RuntimeError, match="stopped"):
        build(builder, ["snapshot_summary"], force=True, checkpoint_every_files=1)
    assert set(snapshots(store, "snapshot_summary")) == {0.0, 1.0, 2.0, 3.0}
    monkeypatch.setattr(FeatureStore, "stage", stage)
    build(builder, ["snapshot_summary"], force=True, checkpoint_every_files=1)
    assert snapshots(store, "snapshot_summary") == {0.0: 1, 1.0: 1, 2.0: 1, 3.0: 1}


def test_many_versions_are_compacted(spark, world, monkeypatch):
    import starfold.plans.build as plans_build

    _, store, builder = world
    monkeypatch.setattr(plans_build, "COMPACT_AFTER", 1)
    build(builder, ["snapshot_summary", "snapshot_singles"], checkpoint_every_files=1)
    for feature, rows in (("snapshot_summary", 1), ("snapshot_singles", 6)):
        assert len(store.pointer("s", feature)["versions"]) == 1
        assert snapshots(store, feature) == {t: rows for t in (0.0, 1.0, 2.0, 3.0)}
    build(builder, ["snapshot_summary"])
    assert store.manifest("s", "snapshot_summary").count() == 3


def test_primordial_pairs_are_known_in_every_batch(spark, world):
    root, store, builder = world
    for t in (6.0, 7.0):
        path = root / "r2" / f"snap.40_{t:.0f}.h5part"
        made = step(t)
        for key in made[1]:
            if key.endswith(("Bin KW1", "Bin KW2")):
                made[1][key] = np.full(3, 1, dtype="int32")
            if key.endswith(("Bin M1*", "Bin M2*")):
                made[1][key] = np.full(3, 4.0, dtype="float32")
            if "Teff" in key or "TE" in key:
                made[1][key] = np.full(3, 15_000.0, dtype="float32")
        fake_h5.write_file(path, {"Step#0": made})
        touch(path, 1000.0 + t)
    build(builder, ["b_type_binary"], checkpoint_every_files=1)
    rows = store.read("s", "b_type_binary")
    assert rows.count() > 0 and store.has("s", "primordial_binary")
    flags = {(r["object_id_1"], r["is_primordial_binary"]) for r in rows.collect()}
    assert flags == {(i, i in (11, 31)) for i in {x for x, _ in flags}}
    assert "primordial" in store.meta("s", "b_type_binary")


def test_unreadable_step_leaves_the_whole_file_out(spark, world):
    root, store, builder = world
    bad = root / "r2" / "snap.40_8.h5part"
    broken = step(8.0)
    del broken[1]["000 Scalars"]
    fake_h5.write_file(bad, {"Step#0": step(2.0, mass=7.0), "Step#1": broken})
    touch(bad, 1030.0)
    build(builder, expand_features(["lake"]), skip_unreadable_files=True)
    # the readable file keeps ttot 2, although the broken one is newer
    assert snapshots(store, "snapshot_singles") == {0.0: 6, 1.0: 6, 2.0: 6, 3.0: 6}
    assert {r["mass_msun"] for r in store.read("s", "snapshot_singles").where("ttot = 2").collect()} == {300.0}
    found = store.bad_files("s", "snapshot_singles").collect()
    assert [r["source_hdf5_path"] for r in found] == [str(bad)] and "000 Scalars" in found[0]["problem"]


def test_paths_are_literal(spark, world):
    root, _, builder = world
    odd = root / "r1" / "snap[1]*?.h5part"
    fake_h5.write_file(odd, {"Step#0": step(9.0)})
    good = str(root / "r1" / "snap.40_2.h5part")
    assert builder.raw("singles", [good, str(odd)]).count() == 12
    os.remove(odd)
    with pytest.raises(Exception, match="No such file"):
        builder.raw("singles", [good, str(odd)]).count()


def test_build_leaves_no_intermediate_tables(spark, world):
    from starfold.plans import fs
    from starfold.session import work_root

    _, _, builder = world
    before = set(fs.children(spark, work_root(spark)))
    build(builder, ["snapshot_scalars", "compact_binary_count"])
    made = set(fs.children(spark, work_root(spark))) - before
    assert not {n for n in made if n.startswith(("raw-", "snapshot_", "catalog", "winners", "steps"))}


def test_new_file_opens_only_itself(spark, world, monkeypatch):
    root, store, builder = world
    build(builder, ["snapshot_summary"])
    new = root / "r2" / "snap.40_4.h5part"
    fake_h5.write_file(new, {"Step#0": step(4.0)})
    touch(new, 1010.0)
    asked = []
    raw = Builder.raw
    monkeypatch.setattr(Builder, "raw", lambda self, table, paths, *a, **b: asked.append((table, tuple(paths))) or raw(self, table, paths, *a, **b))
    build(builder, ["snapshot_summary"])
    assert {p for _, paths in asked for p in paths} == {str(new)}


def test_no_shared_folder_is_an_error_off_local_mode():
    from types import SimpleNamespace

    from starfold.session import shared_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session)


def test_a_large_run_lands_in_several_files(spark, tmp_path):
    """One run with nearly all rows is cut by size; no task writes or streams it whole."""
    from starfold.streaming import ingest

    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "20KB")
    try:
        rows = spark.range(20_000).selectExpr("if(id % 100 = 0, 'b', 'a') run_dir", "xxhash64(id) v", "id", "'s' simulation_id", "1D ttot")
        files = ingest.land(rows.repartition(8), str(tmp_path / "l"), "run_dir")
    finally:
        spark.conf.set(size, before)
    landed = spark.read.parquet(str(tmp_path / "l")).groupBy("run_dir").count().collect()
    assert {r["run_dir"]: r["count"] for r in landed} == {"a": 19_800, "b": 200}
    assert files > 4
