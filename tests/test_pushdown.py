"""What the snapshot source reads: columns, steps, slices and filters."""

import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import fake_h5  # noqa: E402
from test_build import NOW, OPENER, build, step, world  # noqa: E402, F401

from starfold.plans.build import FEATURES, LEFT_OUT, Builder, Job, ScanOptions  # noqa: E402
from starfold.plans.store import FeatureStore  # noqa: E402
from starfold.sources.h5part import H5PartDataSource  # noqa: E402

LOGGED = "fake_h5:open_logged"


def read(spark, path, table="singles", opener=OPENER, **options):
    spark.dataSource.register(H5PartDataSource)
    reader = spark.read.format("h5part").option("table", table).option("opener", opener)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load(str(path))


def taken(path):
    """(step, dataset) pairs read from a file since the last call."""
    log = f"{path}.log"
    if not os.path.exists(log):
        return set()
    with open(log) as lines:
        out = {tuple(line.rstrip("\n").split("\t")) for line in lines}
    os.truncate(log, 0)
    return out


def test_filter_on_time_skips_steps(spark, world):  # noqa: F811
    path = world[0] / "r1" / "snap.40_0.h5part"
    rows = read(spark, path, opener=LOGGED).where("TTOT >= 1 AND TTOT < 2")
    assert {r["TTOT"] for r in rows.collect()} == {1.0}
    assert {s for s, d in taken(path) if d != "000 Scalars"} == {"Step#1"}
    assert {r["TTOT"] for r in read(spark, path).where("TTOT IN (0, 7)").collect()} == {0.0}
    assert read(spark, path).where("TTOT = 0 OR Name = 3").count() == 7
    assert {r["TTOT"] for r in read(spark, path, table="steps").where("TTOT > 0").collect()} == {1.0}


def test_filter_on_path_prunes_partitions(spark, world):  # noqa: F811
    root = world[0]
    every = read(spark, root)
    path = str(root / "r1" / "snap.40_2.h5part")
    one = every.where(F.col("source_hdf5_path") == path)
    assert every.rdd.getNumPartitions() == 3 and one.rdd.getNumPartitions() == 1
    assert {r["source_hdf5_path"] for r in one.select("source_hdf5_path").distinct().collect()} == {path}


@pytest.mark.parametrize("size", [700, 3000, 10**9])
def test_slices_hold_every_row_once(spark, tmp_path, size):
    """A file of one long and two short steps, cut at any size, gives the rows of the whole file."""
    spark.sparkContext.addPyFile(fake_h5.__file__)
    path = tmp_path / "snap.40_1.h5part"
    steps = {"Step#0": step(0.0, n=6), "Step#1": step(1.0, n=1), "Step#2": step(1.0, mass=5.0)}
    attrs, data = steps["Step#0"]
    long = {k: np.arange(997).astype(v.dtype) if k[:3] != "000" and int(k[:3]) < 100 else v for k, v in data.items()}
    steps["Step#3"] = (attrs, {**long, "000 Scalars": step(4.0)[1]["000 Scalars"]})
    fake_h5.write_file(path, steps)
    rows = read(spark, path, slice_bytes=str(size))
    parts = rows.rdd.getNumPartitions()
    assert parts == max(1, -(-os.path.getsize(path) // size))
    got = sorted((r["TTOT"], r["Name"]) for r in rows.select("TTOT", "Name").collect())
    assert got == sorted([(0.0, float(i)) for i in range(1, 7)] + [(1.0, 1.0)] + [(4.0, float(i)) for i in range(997)])
    for table, n in (("scalars", 3), ("steps", 4)):
        assert read(spark, path, table=table, slice_bytes=str(size)).count() == n
    most = rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert parts == 1 or most < 997


def test_build_reads_four_columns(spark, world):  # noqa: F811
    """compact_binary_count takes names and types of pairs only, and only steps that a file stands for."""
    root, store, _ = world
    builder = Builder(store, {"s": str(root)}, opener=LOGGED, now=lambda: NOW)
    build(builder, ["compact_binary_count"])
    files = [root / "r1" / "snap.40_0.h5part", root / "r1" / "snap.40_2.h5part", root / "r2" / "snap.40_3.h5part"]
    first, lost, last = map(taken, files)
    names = {d.split(" ", 1)[1] for _, d in first | last} - {"Scalars"}
    assert names == {"Bin Name1", "Bin Name2", "Bin KW1", "Bin KW2"}
    assert {d for _, d in lost} == {"000 Scalars"}
    assert not {d for s, d in first if s == "Step#10"} - {"000 Scalars"}
    assert store.read("s", "compact_binary_count").count() > 0


def test_features_with_and_without_column_lists_agree(spark, world, tmp_path):  # noqa: F811
    """Every feature alone (its own columns) and all together (all columns) give the same rows."""
    root, store, builder = world
    names = ["compact_binary_count", "current_lagrangian", "compact_object_history"]
    build(builder, [*names, "snapshot_singles", "snapshot_binaries"])
    for name in names:
        other = FeatureStore(spark, str(tmp_path / name), None, ("s",))
        alone = Builder(other, {"s": str(root)}, opener=OPENER, now=lambda: NOW, slice_bytes=900)
        build(alone, [name])
        a, b = (sorted(map(str, s.read("s", name).collect())) for s in (store, other))
        assert a == b and a


def test_bad_slice_makes_the_whole_file_bad(spark, world):  # noqa: F811
    root, store, _ = world
    attrs, data = step(6.0)
    data["102 Bin Name2"] = data["102 Bin Name2"][:1]
    bad = root / "r2" / "snap.40_6.h5part"
    fake_h5.write_file(bad, {"Step#0": step(5.0), "Step#1": step(5.5), "Step#2": (attrs, data)})
    os.utime(bad, (1010.0, 1010.0))
    builder = Builder(store, {"s": str(root)}, opener=OPENER, now=lambda: NOW, slice_bytes=500)
    build(builder, ["snapshot_singles"], skip_unreadable_files=True)
    assert {r["ttot"] for r in store.read("s", "snapshot_singles").collect()} == {0.0, 1.0, 2.0, 3.0}
    found = store.bad_files("s", "snapshot_singles").collect()
    assert [r["source_hdf5_path"] for r in found] == [str(bad)] and "differ in length" in found[0]["problem"]


def test_files_left_out_are_recorded(spark, world):  # noqa: F811
    root, store, builder = world
    for name in ("odd", "snap.40_x"):
        fake_h5.write_file(root / "r1" / f"{name}.h5part", {"Step#0": step(9.0)})
        os.utime(root / "r1" / f"{name}.h5part", (1000.0, 1000.0))
    fake_h5.write_file(root / "r2" / "snap.40_2.h5part", {"Step#0": step(2.0), "Step#1": step(2.5)})
    os.utime(root / "r2" / "snap.40_2.h5part", (1000.0, 1000.0))
    builder.add(Job("s", FEATURES["snapshot_scalars"], ScanOptions(sample_every_nb_time=2.0)))
    builder.run()
    rows = {os.path.relpath(r["path"], root): r["left_out"] for r in store.read("s", LEFT_OUT).collect()}
    assert rows == {
        "r1/odd.h5part": "no time in the name", "r1/snap.40_x.h5part": "no time in the name",
        "r1/snap.40_2.h5part": "another file of this time is larger", "r2/snap.40_3.h5part": "off the time grid",
    }
