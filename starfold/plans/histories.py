"""Particle histories as a stored table that grows by deltas.

Rows belong to a bucket of particles (`object_id` modulo `buckets`, fixed by the first update) and to the update
that wrote them. An update stages its own rows only, whatever is stored already. A read keeps the row of the newest update
per (particle, ttot). `compact_histories` merges the updates of a bucket into one and rewrites no other
bucket. Files are ranges of (bucket, object_id) with stored ends and bloom filters, so the history of one particle
is read from the few files that may hold it. The ranges of an update are chosen from a sample of its ids alone, so its
wide rows cross one shuffle, into the partitions that are joined and become files.

Updates are named by the number of the pointer they saw and a random part, so writers at the same time keep each other's
rows; a merged update is named after the newest one in it and sorts before every later one.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from starfold.operators import history
from starfold.plans.store import COMPACT_AFTER, FeatureStore
from starfold.session import materialize

FEATURE = "particle_history"
BUCKETS = 256
# Updates of one bucket before they are merged.
DELTAS = 8
# Rows of singles and members that a file of an update is made of.
FILE_ROWS = 1 << 18
# Sampled ids a file, from which its ends are chosen, and in all.
_SAMPLED, _SAMPLED_IN_ALL = 100, 200_000
# Ends of a bucket that are looked through at once.
_BLOCK = 32
_BUCKET, _DELTA, _PART, _SOURCE = "history_bucket", "history_delta", "source_hdf5_path", "sighting_path"
# What a merged update's name ends with; it has one row per (particle, ttot).
_MERGED = "+"


def last_sightings(singles: DataFrame, keys: list[str] = history.KEY) -> DataFrame:
    """One row per (particle, ttot): that of the last file, ties by the largest values."""
    order = [c for c in (_PART, *sorted(singles.columns)) if c in singles.columns and c not in keys]
    return history.first_row(singles, keys, *(F.desc_nulls_last(c) for c in order))


def _name(bucket: Column, delta: Column) -> Column:
    return F.concat_ws("/", F.lpad(bucket.cast("string"), 8, "0"), delta)


def _bucket(buckets: int) -> Column:
    return F.coalesce(F.pmod("object_id", F.lit(buckets)), F.lit(0)).cast("int")


def _cuts(ids: DataFrame, buckets: int) -> list[tuple[int, int]]:
    """(bucket, object_id) at which the files of an update after the first begin, from a sample of its ids, so that they get
    about as many rows each: FILE_ROWS, or as many files as shuffle partitions where Spark is told to keep those."""
    conf, rows = ids.sparkSession.conf, ids.count()
    files = math.ceil(rows / FILE_ROWS)
    if not all(conf.get(f"spark.sql.adaptive.{k}enabled") == "true" for k in ("", "coalescePartitions.")):
        files = int(conf.get("spark.sql.shuffle.partitions"))
    if files <= 1 or not rows:
        return []
    fraction = min(1.0, min(_SAMPLED * files, _SAMPLED_IN_ALL) / rows)
    kept = ids.where("object_id is not null").sample(False, fraction, seed=0)
    found = sorted((r[0], r[1]) for r in kept.select(_bucket(buckets), "object_id").collect())
    return sorted({found[len(found) * k // files] for k in range(1, files)}) if found else []


def placing(cuts: list[tuple[int, int]], buckets: int) -> Callable[[DataFrame], DataFrame]:
    """A function that puts rows into the ranges of (bucket, object_id) that begin at the cuts, one partition each.

    Rows without an id belong to bucket 0 and are spread over its ranges by their snapshot.
    """
    ends: list[list[int]] = [[] for _ in range(buckets)]
    for bucket, object_id in cuts:
        ends[bucket].append(object_id)
    before = [sum(map(len, ends[:b])) for b in range(buckets)]

    def of_bucket(values: list, kind: str) -> Column:
        return F.element_at(F.from_json(F.lit(json.dumps(values)), f"array<{kind}>"), _bucket(buckets) + 1)

    def passed(some: Column) -> Column:
        return F.size(F.filter(some, lambda end: end <= F.col("object_id")))

    own = of_bucket(ends, "array<bigint>")
    block = F.greatest(passed(of_bucket([e[::_BLOCK] for e in ends], "array<bigint>")) - 1, F.lit(0)) * _BLOCK
    within = block + passed(F.slice(own, block + 1, _BLOCK))
    nobody = F.pmod(F.hash("simulation_id", "ttot"), F.size(own) + 1)
    place = of_bucket(before, "int") + F.when(F.col("object_id").isNull(), nobody).otherwise(within)
    return lambda rows: rows.withColumn(history.PLACE, place.cast("int")).repartitionById(len(cuts) + 1, F.col(history.PLACE))


def _placing(
    singles: DataFrame, binaries: DataFrame, object_ids: DataFrame | None, buckets: int
) -> Callable[[DataFrame], DataFrame] | None:
    """`placing` by the ids of these tables, None where one file is enough."""
    each = F.explode(F.array("object_id_1", "object_id_2")).alias("object_id")
    ids = singles.select(*history.OBJECT).unionByName(binaries.select("simulation_id", each))
    if object_ids is not None:
        ids = ids.join(object_ids.select(*history.OBJECT).distinct(), history.OBJECT, "left_semi")
    cuts = _cuts(ids, buckets)
    return placing(cuts, buckets) if cuts else None


def _add(
    store: FeatureStore, simulation_id: str, rows: DataFrame, buckets: int, delta: str, replaces: tuple | None, placed: bool
) -> None:
    named = rows.withColumnRenamed(_PART, _SOURCE).withColumns({_BUCKET: _bucket(buckets), _DELTA: F.lit(delta)})
    named = named.withColumn(_PART, _name(F.col(_BUCKET), F.col(_DELTA)))
    version = store.stage(simulation_id, FEATURE, named, None, placed)
    store.publish(simulation_id, FEATURE, [version], {"buckets": buckets}, _PART, replaces=replaces)


def update_histories(
    store: FeatureStore,
    simulation_id: str,
    singles: DataFrame,
    binaries: DataFrame,
    object_ids: DataFrame | None = None,
    *,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Extend the stored particle histories by new snapshots; new rows replace old ones."""
    state = store.pointer(simulation_id, FEATURE)
    delta = f"{state.get('number', 0):08d}-{uuid.uuid4().hex[:12]}"
    stored = state.get("meta", {}).get("buckets")
    if state and not stored:  # a table written as a whole, without buckets
        new = history.particle_history(singles, binaries, object_ids, sightings=last_sightings)
        _add(store, simulation_id, history.merge_history(store.read(simulation_id, FEATURE), new), buckets, delta, None, False)
    else:
        place = _placing(singles, binaries, object_ids, stored or buckets)
        new = history.particle_history(singles, binaries, object_ids, sightings=last_sightings, place=place)
        _add(store, simulation_id, new, stored or buckets, delta, (), place is not None)
    if len(store.pointer(simulation_id, FEATURE)["versions"]) > COMPACT_AFTER:
        compact_histories(store, simulation_id)
        store.compact(simulation_id, FEATURE)
    return read_histories(store, simulation_id)


def _newest(rows: DataFrame) -> DataFrame:
    """The row of the newest update per (particle, ttot), in the columns of a history."""
    if _DELTA not in rows.columns:
        return rows
    return _columns(history.first_row(rows, history.KEY, F.desc(_DELTA)))


def _columns(rows: DataFrame) -> DataFrame:
    """Stored rows in the columns of a history."""
    return rows.drop(_BUCKET, _DELTA, _PART).withColumnRenamed(_SOURCE, _PART)


def _live(store: FeatureStore, simulation_id: str, number: int | None = None) -> DataFrame:
    """(name, bucket, update) of the stored updates that count."""
    parts = F.split(_PART, "/")
    return store.manifest(simulation_id, FEATURE, number).where("problem is null").select(
        _PART, parts[0].cast("int").alias(_BUCKET), parts[1].alias(_DELTA)
    )


def read_histories(store: FeatureStore, simulation_id: str) -> DataFrame:
    """All stored histories, one row per (particle, ttot). Updates are compared only while a bucket has rows of others
    than one merged update."""
    number = store.pointer(simulation_id, FEATURE).get("number")
    rows = store.read(simulation_id, FEATURE, number=number, settled=True)
    live = _live(store, simulation_id, number).groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n"), F.max(_DELTA).alias("_last"))
    if _DELTA in rows.columns and live.where((F.col("n") > 1) | ~F.col("_last").endswith(_MERGED)).isEmpty():
        return _columns(rows)
    return _newest(rows)


def read_history(store: FeatureStore, simulation_id: str, object_id: int) -> DataFrame | None:
    """Stored history of one particle from the files that may hold it, None when there is no history table."""
    state = store.pointer(simulation_id, FEATURE)
    if not state:
        return None
    ranges = {"object_id": (object_id, object_id)}
    if buckets := state["meta"].get("buckets"):
        ranges[_BUCKET] = (object_id % buckets, object_id % buckets)
    return _newest(store.read(simulation_id, FEATURE, ranges))


def compact_histories(store: FeatureStore, simulation_id: str, deltas: int = DELTAS) -> DataFrame:
    """Merge the updates of every bucket that has more than `deltas` of them; returns those buckets.

    The entries of merged updates point to the version that has no rows of them, so their rows are dead at once.
    Rows cross one shuffle, into the ranges of (bucket, object_id) that become files; updates meet inside of a range.
    """
    live = _live(store, simulation_id)
    crowded = materialize(
        live.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n"), F.max(_DELTA).alias("_last")).where(F.col("n") > deltas), "crowded"
    )
    if crowded.isEmpty():
        return crowded.drop("_last")
    last = F.concat("_last", F.lit(_MERGED))
    rows = store.read(simulation_id, FEATURE, settled=True).drop(_PART).join(crowded.drop("n"), _BUCKET)
    placed = rows.repartitionByRange(_BUCKET, "object_id", "simulation_id")
    # in the order of the rows of a file, which then need no other sort
    merged = history.first_row(placed, ["object_id", "ttot", "simulation_id", _BUCKET], F.desc(_DELTA))
    merged = merged.withColumn(_DELTA, last).drop("_last").withColumn(_PART, _name(F.col(_BUCKET), F.col(_DELTA)))
    gone = live.join(crowded, _BUCKET, "left_semi").select(_PART, F.lit(0.0).alias("mtime"), F.lit("merged").alias("problem"))
    new = crowded.select(
        _name(F.col(_BUCKET), last).alias(_PART), F.lit(0.0).alias("mtime"), F.lit(None).cast("string").alias("problem")
    )
    store.commit(simulation_id, FEATURE, merged, materialize(new.unionByName(gone), "merged"), placed=True)
    return crowded.drop("_last")
