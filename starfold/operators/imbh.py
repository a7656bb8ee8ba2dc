"""Intermediate-mass black holes: sightings, mergers, generations, formation and fate."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from starfold.functions import energetics as en, tags
from starfold.functions.numeric import norm3
from starfold import constants as K
from starfold.operators.asof import asof_join
from starfold.operators.history import first_row
from starfold.operators.paths import longest_paths
from starfold.operators.snapshot import SNAPSHOT, with_radius
from starfold.session import materialize

OBJECT = ["simulation_id", "object_name"]
GENERATION_BLOCK = 200_000


def imbh_sightings(singles: DataFrame, binaries: DataFrame, scalars: DataFrame) -> DataFrame:
    """One row per IMBH and snapshot; a pair sighting replaces a single one.

    The mass and type filter runs on each narrow scan before anything is joined.
    """
    num, ids = F.lit(None).cast("double"), F.lit(None).cast("bigint")
    path = lambda df: (
        F.col("source_hdf5_path")
        if "source_hdf5_path" in df.columns
        else F.lit(None).cast("string")
    )
    stars = with_radius(singles.where(tags.is_imbh("kw", "mass_msun"))).select(
        *SNAPSHOT,
        F.col("object_id").alias("object_name"),
        F.lit("single").alias("state"),
        F.lit(None).cast("int").alias("component_index"),
        F.col("mass_msun").cast("double").alias("mass_msun"),
        "kw",
        F.col("r_pc").alias("radius_pc"),
        *[F.col(f"{a}_pc").cast("double").alias(f"{a}_pc") for a in "xyz"],
        norm3("vx_kms", "vy_kms", "vz_kms").alias("speed_kms"),
        ids.alias("companion_name"),
        num.alias("companion_mass_msun"),
        F.lit(None).cast("int").alias("companion_kw"),
        F.lit(None).cast("string").alias("binary_pair_key"),
        ids.alias("binary_cm_name"),
        num.alias("binary_total_mass_msun"),
        num.alias("binary_a_au"),
        num.alias("binary_ecc"),
        num.alias("tau_gw_myr"),
        path(singles).alias("source_hdf5_path"),
    )

    def member(i: int) -> Column:
        o = 3 - i
        return F.struct(
            F.lit(i).alias("component_index"),
            F.col(f"object_id_{i}").alias("object_name"),
            F.col(f"mass_{i}_msun").cast("double").alias("mass_msun"),
            F.col(f"kw_{i}").alias("kw"),
            F.col(f"object_id_{o}").alias("companion_name"),
            F.col(f"mass_{o}_msun").cast("double").alias("companion_mass_msun"),
            F.col(f"kw_{o}").alias("companion_kw"),
        )

    holes = binaries.where(
        tags.is_imbh("kw_1", "mass_1_msun") | tags.is_imbh("kw_2", "mass_2_msun")
    )
    members = (
        with_radius(holes, "cm_")
        .select("*", F.explode(F.array(member(1), member(2))).alias("s"))
        .where(tags.is_imbh("s.kw", "s.mass_msun"))
        .select(
            *SNAPSHOT,
            "s.object_name",
            F.lit("binary").alias("state"),
            "s.component_index",
            "s.mass_msun",
            "s.kw",
            F.col("r_pc").alias("radius_pc"),
            *[F.col(f"cm_{a}_pc").cast("double").alias(f"{a}_pc") for a in "xyz"],
            norm3("cm_vx_kms", "cm_vy_kms", "cm_vz_kms").alias("speed_kms"),
            "s.companion_name",
            "s.companion_mass_msun",
            "s.companion_kw",
            tags.pair_key_text("s.object_name", "s.companion_name").alias("binary_pair_key"),
            F.col("cm_id").alias("binary_cm_name"),
            (F.col("mass_1_msun") + F.col("mass_2_msun"))
            .cast("double")
            .alias("binary_total_mass_msun"),
            F.col("semi_major_axis_au").cast("double").alias("binary_a_au"),
            F.col("eccentricity").cast("double").alias("binary_ecc"),
            en.tau_gw_myr(
                "semi_major_axis_au",
                "eccentricity",
                "mass_1_msun",
                "mass_2_msun",
                K.UNIVERSE_AGE_MYR,
            ).alias("tau_gw_myr"),
            path(binaries).alias("source_hdf5_path"),
        )
    )
    both = first_row(
        stars.unionByName(members),
        [*SNAPSHOT, "object_name"],
        F.when(F.col("state") == "binary", 0).otherwise(1),
        F.desc("component_index"),
        F.desc("companion_name"),
    )
    tidal, escape = tags.escape_radius_pc("tidal_1", "rbar_pc")
    context = scalars.select(
        *SNAPSHOT,
        (F.col("ttot") * F.col("tscale_myr")).alias("time_myr"),
        tidal.alias("tidal_radius_pc"),
        escape.alias("escape_radius_pc"),
    )
    return both.join(context, SNAPSHOT, "left").withColumn(
        "is_escape_candidate",
        F.coalesce(F.col("radius_pc") > F.col("escape_radius_pc"), F.lit(False)),
    )


def imbh_mergers(events: DataFrame, sightings: DataFrame) -> DataFrame:
    """Merger events with an IMBH parent or product, the heavier parent surviving.

    Parents are matched against the known IMBH names with one semi-join over (event, parent)
    rows rather than one join per parent.
    """
    m1, m2 = F.col("parent_mass_1_msun"), F.col("parent_mass_2_msun")
    second = F.when(m1.isNotNull() & m2.isNotNull(), m2 > m1).otherwise(m2.isNotNull())
    survivor = F.when(second, 2).otherwise(1)

    def by_survivor(first: str, other: str) -> Column:
        return F.when(F.col("survivor_parent_index") == 1, F.col(first)).otherwise(F.col(other))

    product_mass = F.when(
        m1.isNotNull() | m2.isNotNull(),
        F.coalesce(m1, F.lit(0.0)) + F.coalesce(m2, F.lit(0.0)),
    )
    rows = events.withColumn("survivor_parent_index", survivor).withColumns(
        {
            "product_name": by_survivor("parent_name_1", "parent_name_2"),
            "discarded_parent_name": by_survivor("parent_name_2", "parent_name_1"),
            "product_kw": by_survivor("parent_kw_1", "parent_kw_2"),
            "product_mass_msun": product_mass,
            "equal_mass_survivor_fallback": F.coalesce(m1 == m2, F.lit(False)),
        }
    )
    rows = rows.withColumns(
        {
            "is_imbh_product": tags.is_imbh("product_kw", "product_mass_msun"),
            "_heavy": tags.is_imbh("parent_kw_1", m1) | tags.is_imbh("parent_kw_2", m2),
        }
    )
    known = sightings.select(*OBJECT).distinct()
    parents = rows.select(
        "simulation_id", "seq", F.explode(F.array("parent_name_1", "parent_name_2")).alias("name")
    )
    named = known.withColumnRenamed("object_name", "name")
    linked = (
        parents.join(named, ["simulation_id", "name"], "left_semi")
        .select("simulation_id", "seq")
        .distinct()
        .withColumn("_known", F.lit(True))
    )
    out = rows.join(linked, ["simulation_id", "seq"], "left").withColumn(
        "has_imbh_parent", F.col("_known").isNotNull() | F.col("_heavy")
    )
    return out.where(F.col("is_imbh_product") | F.col("has_imbh_parent")).drop("_known", "_heavy")


def _fold(pdf: pd.DataFrame) -> pd.DataFrame:
    """Ordered fold of one simulation of few events: gen(product) = 1 + max(gen of the parents)."""
    pdf = pdf.sort_values(["ttot", "seq"])
    gen: dict[int, int] = {}
    for product, p1, p2 in zip(*(pdf[c].to_numpy() for c in ("product_name", "parent_name_1", "parent_name_2"))):
        grown = 1 + max(gen.get(p1, 0), gen.get(p2, 0))
        gen[product] = max(gen.get(product, 0), grown)
    names = sorted(gen)
    return pd.DataFrame(
        {
            "simulation_id": [pdf["simulation_id"].iloc[0]] * len(names),
            "product_name": names,
            "generation": [gen[n] for n in names],
        }
    ).astype({"product_name": "int64", "generation": "int64"})


def merger_generations(mergers: DataFrame, block: int = GENERATION_BLOCK) -> DataFrame:
    """Hierarchical generation of every merger product.

    A simulation of at most `block` events is folded in one task of bounded size. Longer ones are settled over
    the graph of events by `event_generations`; both give the same numbers.
    """
    names = ("product_name", "parent_name_1", "parent_name_2")
    events = mergers.select(
        "simulation_id", "ttot", "seq", *[F.col(c).cast("bigint").alias(c) for c in names]
    ).where(F.col("product_name").isNotNull() & F.col("ttot").isNotNull())
    kind = "simulation_id string, product_name bigint, generation bigint"
    sizes = materialize(events.groupBy("simulation_id").agg(F.count(F.lit(1)).alias("_n")), "merger-counts")
    few = events.join(sizes.where(F.col("_n") <= block), "simulation_id", "left_semi")
    folded = few.groupBy("simulation_id").applyInPandas(_fold, kind)
    many = sizes.where(F.col("_n") > block)
    if many.isEmpty():
        return folded
    return folded.unionByName(event_generations(events.join(many, "simulation_id", "left_semi")))


def _links(events: DataFrame) -> DataFrame:
    """(id, pred, w): each event with the last earlier events that made its product (w = 0) and its parents (w = 1).

    The product's own line has w = 1 where the product is one of the parents.
    """
    asked = events.select(
        "simulation_id", "at", "id",
        F.inline(F.array(*[
            F.struct(F.col(c).alias("name"), F.lit(w).alias("w"))
            for c, w in (("product_name", 0), ("parent_name_1", 1), ("parent_name_2", 1))
        ])),
    )
    asked = asked.where(F.col("name").isNotNull()).groupBy("simulation_id", "at", "id", "name").agg(F.max("w").alias("w"))
    made = events.select("simulation_id", "at", F.col("product_name").alias("name"), F.col("id").alias("pred"))
    joined = asof_join(asked, made, ["simulation_id", "name"], "at", allow_equal=False)
    return joined.where(F.col("found").isNotNull()).select("id", F.col("found.pred").alias("pred"), "w")


def event_generations(events: DataFrame) -> DataFrame:
    """Generations of simulations with very many events, as longest paths in the graph of events.

    Every event is linked with the last earlier events that made its product and its parents, found by an as-of join.
    """
    order = ["ttot", "seq", "product_name", "parent_name_1", "parent_name_2"]
    placed = materialize(
        events.repartitionByRange("simulation_id", *order)
        .sortWithinPartitions("simulation_id", *order)
        .withColumn("id", F.monotonically_increasing_id()),
        "ordered-mergers",
    )
    # ids follow the order, so they serve as the time of the as-of join
    links = _links(placed.withColumn("at", F.col("id")))
    found = longest_paths(placed.select("id", F.lit(1).alias("base")), links)
    return (
        placed.join(found, "id")
        .groupBy("simulation_id", "product_name")
        .agg(F.max("value").alias("generation"))
    )


def imbh_objects(
    sightings: DataFrame, mergers: DataFrame, generations: DataFrame, scalars: DataFrame
) -> DataFrame:
    """One row per IMBH: time range, states, formation channel, generation and fate."""
    bounds = scalars.groupBy("simulation_id").agg(
        F.min("ttot").alias("_scan0"), F.max("ttot").alias("_scan1")
    )
    escape_t = F.when(F.col("is_escape_candidate"), F.col("ttot"))
    objects = sightings.groupBy(*OBJECT).agg(
        F.min("ttot").alias("first_ttot"),
        F.max("ttot").alias("last_ttot"),
        F.min_by("time_myr", "ttot").alias("first_time_myr"),
        F.max_by("time_myr", "ttot").alias("last_time_myr"),
        F.max("mass_msun").alias("max_mass_msun"),
        F.min("mass_msun").alias("_min_mass"),
        F.count(F.lit(1)).alias("n_snapshots"),
        F.array_join(F.sort_array(F.collect_set("state")), ",").alias("states_seen"),
        F.min(escape_t).alias("first_escape_ttot"),
        F.min_by("time_myr", escape_t).alias("first_escape_time_myr"),
    )
    gen = generations.select(
        "simulation_id", F.col("product_name").alias("object_name"), "generation"
    )
    later = (
        mergers.select(
            "simulation_id",
            F.col("discarded_parent_name").alias("object_name"),
            F.col("ttot").alias("_event"),
            "product_name",
            "seq",
        )
        .join(objects.select(*OBJECT, "last_ttot"), OBJECT)
        .where(F.col("_event") >= F.col("last_ttot"))
        .groupBy(*OBJECT)
        .agg(F.min(F.struct("_event", "seq", "product_name")).alias("_merged"))
    )
    joined = (
        objects.join(bounds, "simulation_id", "left")
        .join(gen, OBJECT, "left")
        .join(later, OBJECT, "left")
        .withColumn("generation", F.coalesce("generation", F.lit(0).cast("bigint")))
    )
    at_start = F.abs(F.col("first_ttot") - F.col("_scan0")) <= 1e-9
    at_end = F.abs(F.col("last_ttot") - F.col("_scan1")) <= 1e-9
    grew = (F.col("n_snapshots") > 1) & (F.col("_min_mass") < F.col("max_mass_msun"))
    channel = (
        F.when(at_start, "already_imbh_at_scan_start")
        .when(F.col("generation") >= 2, "hierarchical_merger")
        .when(F.col("generation") == 1, "first_generation_merger")
        .when(grew, "unlinked_mass_growth")
        .otherwise("unknown")
    )
    fate = (
        F.when(F.col("_merged").isNotNull(), "merged_into_other")
        .when(F.col("first_escape_ttot").isNotNull(), "escaped_candidate")
        .when(at_end, "retained_candidate")
        .when(F.col("last_ttot") < F.col("_scan1"), "not_seen_at_scan_end")
        .otherwise("unknown")
    )
    return joined.select(
        *OBJECT,
        "first_ttot",
        "last_ttot",
        "first_time_myr",
        "last_time_myr",
        "max_mass_msun",
        "n_snapshots",
        "states_seen",
        channel.alias("formation_channel"),
        F.col("generation").alias("hierarchical_merger_generation"),
        fate.alias("fate_label"),
        F.col("_merged.product_name").alias("fate_product_name"),
        "first_escape_ttot",
        "first_escape_time_myr",
    )


def imbh_population(
    singles: DataFrame, binaries: DataFrame, scalars: DataFrame, events: DataFrame
) -> dict[str, DataFrame]:
    """Sightings, mergers, generations and objects; each is written once and read by the next."""
    sightings = materialize(imbh_sightings(singles, binaries, scalars), "imbh-sightings")
    mergers = materialize(imbh_mergers(events, sightings), "imbh-mergers")
    generations = merger_generations(mergers)
    return {
        "sightings": sightings,
        "mergers": mergers,
        "generations": generations,
        "objects": imbh_objects(sightings, mergers, generations, scalars),
    }


def imbh_counts(objects: DataFrame) -> DataFrame:
    """Objects per formation channel and fate."""
    return objects.groupBy("simulation_id", "formation_channel", "fate_label").agg(
        F.count(F.lit(1)).alias("n_objects")
    )
