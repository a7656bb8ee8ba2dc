"""Stored particle histories: deltas, newest rows, merges per bucket, pruned look-ups."""

import pytest
from pyspark.sql import functions as F

from starfold.plans import histories
from starfold.plans.store import FeatureStore

SINGLES = "simulation_id string, ttot double, object_id long, kw int, mass_msun double, source_hdf5_path string"
BINARIES = "simulation_id string, ttot double, object_id_1 long, object_id_2 long, cm_id long, source_hdf5_path string"


@pytest.fixture
def store(spark, tmp_path):
    return FeatureStore(spark, str(tmp_path / "cache"))


def stars(spark, rows):
    return spark.createDataFrame([("s", float(t), i, 1, float(m), f) for t, i, m, f in rows], SINGLES)


def pairs(spark, rows=()):
    return spark.createDataFrame([("s", float(t), a, b, 1000 + a, "f") for t, a, b in rows], BINARIES)


def held(rows):
    return sorted((r["object_id"], r["ttot"], r["mass_msun"], r["state"]) for r in rows.collect())


def data_files(rows):
    return {f for f in rows.inputFiles() if "/data/" in f}


def files(store):
    return data_files(store.read("s", histories.FEATURE))


def test_newest_row_counts_and_columns_stay(spark, store):
    first = [(t, i, 1, "a") for t in range(3) for i in (1, 2, 5)]
    got = histories.update_histories(store, "s", stars(spark, first), pairs(spark, [(1, 1, 2)]), buckets=4)
    plain = histories.history.particle_history(stars(spark, first), pairs(spark, [(1, 1, 2)]))
    assert sorted(got.columns) == sorted(plain.columns) and held(got) == held(plain)
    got = histories.update_histories(store, "s", stars(spark, [(2, 1, 7, "b"), (3, 1, 8, "b")]), pairs(spark))
    kept = {(r["object_id"], r["ttot"]): (r["mass_msun"], r["source_hdf5_path"]) for r in got.collect()}
    assert len(kept) == got.count() == 10 and kept[1, 2.0] == (7.0, "b") and kept[1, 3.0] == (8.0, "b") and kept[2, 2.0] == (1.0, "a")


def test_repeated_sightings_in_one_update(spark, store):
    """Rows of one (particle, ttot) in several files: the last file's, and never multiplied by the pair."""
    rows = [(0, 1, 1, "a"), (0, 1, 2, "b"), (0, 1, 3, "b"), (0, 2, 5, "a"), (0, 2, 5, "a")]
    got = histories.update_histories(store, "s", stars(spark, rows), pairs(spark, [(0, 1, 2)]))
    assert held(got) == [(1, 0.0, 3.0, "binary"), (2, 0.0, 5.0, "binary")]


def test_update_writes_its_rows_only(spark, store):
    everyone = [(t, i, 1, "a") for t in range(4) for i in range(64)]
    histories.update_histories(store, "s", stars(spark, everyone), pairs(spark), buckets=8)
    before = files(store)
    histories.update_histories(store, "s", stars(spark, [(9, 3, 1, "b")]), pairs(spark))
    added = files(store) - before
    assert before < files(store) and spark.read.parquet(*added).count() == 1


def test_merge_rewrites_crowded_buckets_only(spark, store):
    everyone = [(t, i, 1, "a") for t in range(2) for i in range(16)]
    histories.update_histories(store, "s", stars(spark, everyone), pairs(spark), buckets=8)
    for k in range(3):
        histories.update_histories(store, "s", stars(spark, [(1, 3, 10 + k, "b"), (5 + k, 11, 1, "b")]), pairs(spark))
    before, rows = files(store), held(histories.read_histories(store, "s"))
    assert [tuple(r) for r in histories.compact_histories(store, "s", deltas=3).collect()] == [(3, 4)]
    added = spark.read.parquet(*(files(store) - before))
    assert {r[0] for r in added.select("history_bucket").distinct().collect()} == {3} and added.count() == 4 + 3
    assert held(histories.read_histories(store, "s")) == rows and (3, 1.0, 12.0, "single") in rows
    assert histories.compact_histories(store, "s", deltas=3).count() == 0
    # later updates win over merged rows, and a whole compaction keeps the result
    histories.update_histories(store, "s", stars(spark, [(1, 3, 99, "c")]), pairs(spark))
    store.compact("s", histories.FEATURE)
    assert (3, 1.0, 99.0, "single") in held(histories.read_histories(store, "s"))


def test_two_updates_at_once_keep_both(spark, store, monkeypatch):
    histories.update_histories(store, "s", stars(spark, [(0, 1, 1, "a")]), pairs(spark), buckets=2)
    publish = FeatureStore.publish

    def late(self, *args, **kwargs):
        monkeypatch.setattr(FeatureStore, "publish", publish)
        histories.update_histories(FeatureStore(spark, store.cache_root), "s", stars(spark, [(1, 1, 2, "b")]), pairs(spark))
        publish(self, *args, **kwargs)

    monkeypatch.setattr(FeatureStore, "publish", late)
    got = histories.update_histories(store, "s", stars(spark, [(2, 1, 3, "c")]), pairs(spark))
    assert held(got) == [(1, 0.0, 1.0, "single"), (1, 1.0, 2.0, "single"), (1, 2.0, 3.0, "single")]


def test_one_particle_reads_few_files(spark, store):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        everyone = [(t, i, i, "a") for t in range(3) for i in range(200)]
        histories.update_histories(store, "s", stars(spark, everyone), pairs(spark), buckets=16)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    one = histories.read_history(store, "s", 77)
    assert held(one) == [(77, float(t), 77.0, "single") for t in range(3)]
    assert len(files(store)) >= 4 and len(data_files(one)) <= 2
    assert histories.read_history(store, "s", 10**9).count() == 0


def test_table_written_as_a_whole_is_taken_over(spark, store):
    old = histories.history.particle_history(stars(spark, [(0, 1, 1, "a"), (1, 1, 1, "a")]), pairs(spark))
    store.write_table("s", histories.FEATURE, old)
    assert held(histories.read_histories(store, "s")) == held(old)
    got = histories.update_histories(store, "s", stars(spark, [(1, 1, 2, "b")]), pairs(spark), buckets=4)
    assert held(got) == [(1, 0.0, 1.0, "single"), (1, 1.0, 2.0, "single")]


def test_empty_update_and_nulls(spark, store):
    rows = stars(spark, [(0, 1, 1, "a")])
    nobody = rows.withColumn("object_id", F.lit(None).cast("long"))
    histories.update_histories(store, "s", rows.unionByName(nobody), pairs(spark))
    got = histories.update_histories(store, "s", rows.limit(0), pairs(spark))
    assert sorted((r["object_id"] or 0, r["ttot"]) for r in got.collect()) == [(0, 0.0), (1, 0.0)]
