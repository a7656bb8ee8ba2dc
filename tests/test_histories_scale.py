"""Work that particle histories must not do twice: wide rows written or shuffled again, particles nobody asked for."""

import os

import pytest
from pyspark.sql import functions as F

from starfold.operators import history
from starfold.plans import fs, histories, queries
from starfold.plans.store import FeatureStore
from starfold.session import work_root

SINGLES = "simulation_id string, ttot double, object_id long, kw int, mass_msun double, source_hdf5_path string"
BINARIES = "simulation_id string, ttot double, object_id_1 long, object_id_2 long, cm_id long, source_hdf5_path string"


@pytest.fixture
def frames(spark):
    rows = [("s", float(t), i, t % 2, float(t + i), "f") for t in range(3) for i in range(4)]
    return spark.createDataFrame(rows, SINGLES), spark.createDataFrame([("s", 1.0, 1, 2, 1001, "f")], BINARIES)


def written(spark, label):
    return [n for n in fs.children(spark, work_root(spark)) if n.startswith(f"{label}-")]


def test_stored_rows_are_written_once_and_merged_by_one_shuffle(spark, tmp_path, frames, monkeypatch):
    store, before = FeatureStore(spark, str(tmp_path)), written(spark, histories.FEATURE)
    shuffles = []
    write = FeatureStore._write_rows

    def counted(self, simulation_id, feature, rows, *args):
        write(self, simulation_id, feature, rows, *args)
        shuffles.append(rows._jdf.queryExecution().executedPlan().toString().count("rangepartitioning"))

    monkeypatch.setattr(FeatureStore, "_write_rows", counted)
    for mass in (1.0, 2.0):
        histories.update_histories(store, "s", frames[0].withColumn("mass_msun", F.lit(mass)), frames[1], buckets=2)
    histories.compact_histories(store, "s", deltas=1)
    assert written(spark, histories.FEATURE) == before and shuffles == [0, 0, 1]
    got = histories.read_histories(store, "s")
    assert got.count() == 12 and {r[0] for r in got.select("mass_msun").distinct().collect()} == {2.0}
    assert spark.read.parquet(*store.read("s", histories.FEATURE).inputFiles()[:1]).count() > 0


def test_summary_shuffles_a_history_once(spark, frames):
    rows = history.particle_history(*frames).localCheckpoint()
    out = history.particle_summary(rows)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    one = out.where("object_id = 1").first()
    assert (one["total_snapshots"], one["binary_count"], one["final_mass_msun"], one["stellar_types"]) == (3, 1, 3.0, [0, 1])


def test_only_asked_particles_reach_the_as_of_join(spark, tmp_path, monkeypatch):
    day = "timestamp '1995-03-01'"
    spark.range(6).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber", "1D AS l_quantity", "1D AS l_extendedprice",
        "'A' AS l_returnflag", "'F' AS l_linestatus", f"{day} AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(2).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'F' AS o_orderstatus", "1D AS o_totalprice", f"{day} AS o_orderdate"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(1).selectExpr(
        "id + 640 AS event_id", "3L AS user_id", "'click' AS event_type", f"{day} AS ts"
    ).write.parquet(f"{tmp_path}/events.parquet")
    seen, plain = [], history.history_asked

    def spied(rows, *args):
        seen.extend(r["object_id"] for r in rows.select("object_id").collect())
        return plain(rows, *args)

    monkeypatch.setattr(history, "history_asked", spied)
    for name in ("history_before_merger", "history_after_merger", "history_near_merger"):
        before = written(spark, "lake-snapshot_singles")
        got = queries.QUERIES[name](spark, os.fspath(tmp_path)).collect()
        assert [(r["object_id"], r["found_ttot"]) for r in got] == [(3, None if "after" in name else 2.0)]
        assert written(spark, "lake-snapshot_singles") == before
    assert seen == [3, 3, 3]


@pytest.mark.parametrize("buckets", [1, 3])
def test_placing_is_by_ranges(spark, buckets):
    """Every row goes to the range that its (bucket, object_id) lies in, also with more ends than are looked through at once."""
    ids = sorted({*range(-60, 240, 3), -(2**62), 2**62})
    cuts = sorted({(i % buckets, i) for i in ids[1::2]})
    rows = spark.createDataFrame([("s", float(i % 5), i) for i in [*range(-70, 250), -(2**63), 2**63 - 1]], "simulation_id string, ttot double, object_id long")
    nobody = spark.range(200).selectExpr("'s' simulation_id", "id * 1D ttot", "cast(null as long) object_id")
    placed = histories.placing(cuts, buckets)(rows.unionByName(nobody)).withColumn("at", F.spark_partition_id()).collect()
    assert max(len([c for c in cuts if c[0] == b]) for b in range(buckets)) > (32 if buckets == 1 else 10)
    for r in (r for r in placed if r["object_id"] is not None):
        assert r["at"] == r["_place"] == sum(c <= (r["object_id"] % buckets, r["object_id"]) for c in cuts)
    empty = {r["at"] for r in placed if r["object_id"] is None}
    assert max(empty) <= len([c for c in cuts if c[0] == 0]) and len(empty) > 5


def test_an_update_shuffles_its_wide_rows_once(spark, tmp_path, monkeypatch):
    """Both tables cross one shuffle into the ranges that are joined and written, and no sampling pass runs over them."""
    monkeypatch.setattr(histories, "FILE_ROWS", 100)
    store, plans, write = FeatureStore(spark, str(tmp_path)), [], FeatureStore._write_rows

    def seen(self, simulation_id, feature, rows, version, placed=False):
        plans.append((placed, rows._jdf.queryExecution().executedPlan().toString()))
        write(self, simulation_id, feature, rows, version, placed)

    monkeypatch.setattr(FeatureStore, "_write_rows", seen)
    singles = spark.createDataFrame([("s", float(t), i, 1, float(i), f) for t in range(4) for i in range(150) for f in "ab"], SINGLES)
    nobody = singles.where("object_id < 2 and ttot < 3").withColumn("object_id", F.lit(None).cast("long"))
    pairs = spark.createDataFrame([("s", float(t), i, i + 200, i, "f") for t in range(4) for i in range(0, 150, 3)], BINARIES)
    plain = history.particle_history(histories.last_sightings(singles.unionByName(nobody)), pairs)
    got = histories.update_histories(store, "s", singles.unionByName(nobody), pairs, buckets=4)
    assert [p[0] for p in plans] == [True] and plans[0][1].count("Exchange") == 2
    columns = sorted(plain.columns)
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, plain.select(columns).collect()))
    held = store.read("s", histories.FEATURE).where("object_id is not null")
    key = F.struct("history_bucket", "object_id")
    ends = sorted(tuple(r) for r in held.groupBy(F.input_file_name()).agg(F.min(key).alias("a"), F.max(key).alias("z")).select("a", "z").collect())
    assert len(ends) > 8 and all(z < a for (_, z), (a, _) in zip(ends, ends[1:]))


def test_merged_histories_are_read_as_they_are(spark, tmp_path, frames):
    """After a merge of every bucket its rows are the only ones read, without a comparison of updates."""
    store = FeatureStore(spark, str(tmp_path))
    for mass in (1.0, 2.0):
        histories.update_histories(store, "s", frames[0].withColumn("mass_msun", F.lit(mass)), frames[1], buckets=2)
    unmerged = histories.read_histories(store, "s")
    assert "Window" in unmerged._jdf.queryExecution().executedPlan().toString()
    histories.compact_histories(store, "s", deltas=1)
    got = histories.read_histories(store, "s")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and all("version=3" in f for f in got.inputFiles())
    assert sorted(map(str, got.collect())) == sorted(map(str, unmerged.select(got.columns).collect()))
    histories.update_histories(store, "s", frames[0].where("object_id = 1").withColumn("mass_msun", F.lit(3.0)), frames[1], buckets=2)
    rows = {(r["object_id"], r["mass_msun"]) for r in histories.read_histories(store, "s").collect()}
    assert rows == {(0, 2.0), (1, 3.0), (2, 2.0), (2, None), (3, 2.0)}  # the pair alone was seen again with star 2
