"""Histories of single particles through the snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from starfold import constants as K
from starfold.operators.asof import asof_join
from starfold.operators.snapshot import SNAPSHOT

OBJECT = ["simulation_id", "object_id"]
KEY = [*OBJECT, "ttot"]
# Number of the partition that a caller has chosen for the rows of a key.
PLACE = "_place"
# The key of placed rows; ids come first, as the first column alone decides most comparisons of a sort.
PLACED_KEY = ["object_id", "ttot", "simulation_id", PLACE]
# Order of a star's roles in one snapshot.
_ROLE = ["member", "object_id_1", "object_id_2"]


def first_row(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """First row per key in the given order.

    Spark prunes each input partition to one row per key before the shuffle (window group limit),
    so a key with very many duplicates never reaches one task.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def members(binaries: DataFrame) -> DataFrame:
    """Each pair seen from both members."""
    pair = [c for c in binaries.columns if c not in SNAPSHOT]

    def role(i: int) -> Column:
        return F.struct(
            F.lit(i).alias("member"),
            F.col(f"object_id_{i}").alias("object_id"),
            F.col(f"object_id_{3 - i}").alias("companion_id"),
        )

    return binaries.select(*SNAPSHOT, *pair, F.inline(F.array(role(1), role(2))))


def member_rows(binaries: DataFrame) -> DataFrame:
    """Each pair seen from both members; a star found twice in a snapshot keeps its first role."""
    return first_row(members(binaries), KEY, *_ROLE)


def particle_history(
    singles: DataFrame,
    binaries: DataFrame,
    object_ids: DataFrame | None = None,
    *,
    raw_state: bool = False,
    sightings: Callable[[DataFrame, list[str]], DataFrame] | None = None,
    place: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Full outer join of the single and binary sightings of every particle.

    Colliding columns of the pair get the suffix `_from_binary`. `state` is 'binary' where a pair
    was found. `object_ids` (simulation_id, object_id) restricts the particles. `raw_state` adds
    the compatibility column `state_raw`, NULL for single rows of particles that are ever in a
    pair; it costs one more shuffle. `sightings` picks the single rows of a key that count. `place`
    adds the column PLACE and shuffles by it: rows of both tables then meet there and stay there.
    """
    stars, both = singles, members(binaries)
    if object_ids is not None:
        wanted = object_ids.select(*OBJECT).distinct()
        stars = stars.join(wanted, OBJECT, "left_semi")
        both = both.join(wanted, OBJECT, "left_semi")
    keys = KEY
    if place is not None:
        stars, both, keys = place(stars), place(both), PLACED_KEY
    if sightings is not None:
        stars = sightings(stars, keys)
    pairs = first_row(both, keys, *_ROLE)
    clash = [c for c in pairs.columns if c in stars.columns and c not in keys]
    pairs = pairs.withColumnsRenamed({c: f"{c}_from_binary" for c in clash})
    joined = stars.join(pairs, keys, "full_outer")
    if place is not None:
        joined = joined.select(*KEY, *[c for c in joined.columns if c not in keys])
    paired = F.col("companion_id").isNotNull()
    out = joined.withColumn("state", F.when(paired, "binary").otherwise("single"))
    if not raw_state:
        return out
    ever = F.max(paired).over(W.partitionBy(*OBJECT))
    return out.withColumn("state_raw", F.when(paired, "binary").when(~ever, "single"))


def particle_summary(history: DataFrame) -> DataFrame:
    """One row per particle: counts, time range, first and last mass, types in order seen.

    Summed per stellar type first; at most 17 types per particle remain. Rows cross one shuffle, by particle and with
    the columns that count: a particle has one row per snapshot, so sums made before it would be wider and hardly fewer.
    """
    at_mass = F.when(F.col("mass_msun").isNotNull(), F.struct("ttot", "mass_msun"))
    rows = history.select(*OBJECT, "ttot", "kw", "mass_msun", "state").repartition(*OBJECT)
    by_type = rows.groupBy(*OBJECT, "kw").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("ttot").alias("t0"),
        F.max("ttot").alias("t1"),
        F.count_if(F.col("state") == "single").alias("n_single"),
        F.count_if(F.col("state") == "binary").alias("n_binary"),
        F.min(at_mass).alias("m0"),
        F.max(at_mass).alias("m1"),
    )
    seen = F.collect_list(F.when(F.col("kw").isNotNull(), F.struct("t0", "kw")))
    return by_type.groupBy(*OBJECT).agg(
        F.sum("n").alias("total_snapshots"),
        F.min("t0").alias("first_ttot"),
        F.max("t1").alias("last_ttot"),
        F.sum("n_single").alias("single_count"),
        F.sum("n_binary").alias("binary_count"),
        F.min("m0")["mass_msun"].alias("initial_mass_msun"),
        F.max("m1")["mass_msun"].alias("final_mass_msun"),
        F.transform(F.sort_array(seen), lambda s: s["kw"]).alias("stellar_types"),
    )


def history_at(history: DataFrame, time: float) -> DataFrame:
    """Row nearest to `time` per particle; the earlier of two equally near."""
    return first_row(history, OBJECT, F.abs(F.col("ttot") - time), "ttot")


def history_between(history: DataFrame, start: float, end: float) -> DataFrame:
    return history.where(F.col("ttot").between(start, end))


def history_sampled(history: DataFrame, step: float) -> DataFrame:
    """First row at or after every point of a regular grid that starts at the particle's first row.

    A row is picked exactly when a grid point lies in (previous ttot, ttot].
    """
    step = float(step)
    by_time = W.partitionBy(*OBJECT).orderBy("ttot")
    start = F.first("ttot").over(by_time)
    cell = F.floor((F.col("ttot") - start) / step)
    before = F.floor((F.lag("ttot").over(by_time) - start) / step)
    picked = history.withColumns({"_cell": cell, "_before": before})
    return picked.where(F.col("_before").isNull() | (F.col("_cell") > F.col("_before"))).drop(
        "_cell", "_before"
    )


def filter_history(
    history: DataFrame, time: str | float | tuple[float, float], step: float | None = None
) -> DataFrame:
    """'all', a single time, a closed (start, end) range, or 'sample' with a step."""
    if time == "sample" and step is not None:
        return history_sampled(history, step)
    if isinstance(time, (int, float)):
        return history_at(history, float(time))
    if isinstance(time, (tuple, list)) and len(time) == 2:
        return history_between(history, float(time[0]), float(time[1]))
    return history


def stop_after_gap(
    history: DataFrame,
    files: DataFrame,
    missing: int = K.MISSING_FILES_BEFORE_STOP,
) -> DataFrame:
    """Drop what follows the first run of `missing` consecutive files without the particle.

    `files` has (simulation_id, file_index, ttot), file_index counting from 1 at the resume point.
    """
    located = history.join(files.select("simulation_id", "ttot", "file_index"), SNAPSHOT)
    by_file = W.partitionBy(*OBJECT).orderBy("file_index", "ttot")
    gap = F.col("file_index") - F.lag("file_index", 1, 0).over(by_file) - 1
    flagged = located.withColumn("_gap", gap)
    stopped = F.max(F.when(F.col("_gap") >= missing, 1).otherwise(0)).over(
        by_file.rowsBetween(W.unboundedPreceding, 0)
    )
    return flagged.withColumn("_stopped", stopped).where(F.col("_stopped") == 0).drop(
        "_gap", "_stopped", "file_index"
    )


def merge_history(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new fragments with one row per (particle, ttot), the new one winning."""
    both = old.withColumn("_age", F.lit(1)).unionByName(
        new.withColumn("_age", F.lit(0)), allowMissingColumns=True
    )
    return first_row(both, KEY, "_age").drop("_age")


def resume_points(history: DataFrame) -> DataFrame:
    """Latest ttot already covered, per particle."""
    return history.groupBy(*OBJECT).agg(F.max("ttot").alias("skip_until"))


def evolution_path(history: DataFrame) -> DataFrame:
    """Nested path per particle: epochs in time order, each with its member and its pair.

    An epoch is a snapshot in which type, partner or state changes, so the array stays as short
    as the particle's life has events.
    """
    by_time = W.partitionBy(*OBJECT).orderBy("ttot")
    signature = F.struct("kw", "companion_id", "state")
    changed = ~F.lag(signature).over(by_time).eqNullSafe(signature)
    epochs = history.withColumn("_new", changed).where(
        F.col("_new") | F.col("_new").isNull()
    )
    pair = F.when(
        F.col("companion_id").isNotNull(),
        F.struct(
            F.col("companion_id"),
            F.col("semi_major_axis_au").alias("a"),
            F.col("eccentricity").alias("e"),
        ),
    )
    epoch = F.struct(
        "ttot",
        F.struct("object_id", "mass_msun", "kw").alias("member"),
        pair.alias("pair"),
        F.col("state").alias("event_label"),
    )
    return epochs.groupBy(*OBJECT).agg(F.array_sort(F.collect_list(epoch)).alias("epochs"))


def history_asked(history: DataFrame, asked: DataFrame, direction: str = "backward") -> DataFrame:
    """For every asked (particle, ttot) the state of the particle then: the last, next or nearest row of its history.

    `asked` may have further columns, which are kept. Adds found_ttot, found_kw, found_mass_msun, found_state and
    found_companion_id, NULL where the history has no such row.
    """
    taken = ["ttot", "kw", "mass_msun", "state", "companion_id"]
    rows = history.select(*OBJECT, *taken)
    out = asof_join(asked, rows, OBJECT, "ttot", direction=direction, out="_found")
    return out.select(*asked.columns, *[F.col("_found")[c].alias(f"found_{c}") for c in taken])


def companion_lanes(history: DataFrame) -> DataFrame:
    """(particle, companion_id, lane, first_ttot, last_ttot): stable lanes beside the particle's own lane 0.

    Companions come in the order of their first sighting; each takes the lowest lane that is free and keeps it until
    its last sighting. A lane is free again after the snapshot in which its holder was last seen. One array
    of intervals per particle, as long as it had companions, folded by column expressions.
    """
    seen = history.where(F.col("companion_id").isNotNull()).groupBy(*OBJECT, "companion_id")
    spans = seen.agg(F.min("ttot").alias("first_ttot"), F.max("ttot").alias("last_ttot"))
    span = F.struct("first_ttot", "last_ttot", "companion_id")
    lives = spans.groupBy(*OBJECT).agg(F.array_sort(F.collect_list(span)).alias("spans"))
    kind = lives.schema["spans"].dataType.elementType["companion_id"].dataType.simpleString()
    start = F.expr(f"named_struct('ends', cast(array() as array<double>), 'lanes', cast(array() as array<struct<id:{kind},lane:int>>))")

    def take(state: Column, s: Column) -> Column:
        ends = state["ends"]
        open_lanes = F.filter(F.transform(ends, lambda e, i: F.when(e < s["first_ttot"], i + 1)), lambda i: i.isNotNull())
        lane = F.coalesce(F.get(open_lanes, F.lit(0)), F.size(ends) + 1)
        kept = F.transform(ends, lambda e, i: F.when(i + 1 == lane, s["last_ttot"]).otherwise(e))
        more = F.when(lane > F.size(ends), F.array(s["last_ttot"])).otherwise(F.expr("cast(array() as array<double>)"))
        entry = F.struct(s["companion_id"].alias("id"), lane.alias("lane"))
        return F.struct(F.concat(kept, more).alias("ends"), F.concat(state["lanes"], F.array(entry)).alias("lanes"))

    folded = lives.withColumn("_lanes", F.aggregate("spans", start, take)["lanes"])
    both = F.arrays_zip(F.col("spans"), F.col("_lanes"))
    out = folded.select(*OBJECT, F.explode(both).alias("b"))
    return out.select(
        *OBJECT,
        F.col("b.spans.companion_id").alias("companion_id"),
        F.col("b._lanes.lane").alias("lane"),
        F.col("b.spans.first_ttot").alias("first_ttot"),
        F.col("b.spans.last_ttot").alias("last_ttot"),
    )
