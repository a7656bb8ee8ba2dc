"""Current-mass Lagrangian profiles and the long form of lagr.7 tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starfold import constants as K
from starfold.operators.ordered import select_at_cumulative
from starfold.operators.snapshot import SNAPSHOT, with_radius
from starfold.session import materialize

SUFFIXES = (*K.LAGR_FRACTIONS, K.LAGR_CORE)
_MOMENTS = ("m", "n", "px", "py", "pz", "mv", "mr", "mt", "mv2", "mr2", "mrot")


def _mass_targets(total: Column) -> list[tuple[Column, Column]]:
    """Cumulative-mass target of every fraction."""
    return [(F.lit(s), total * F.lit(float(s))) for s in K.LAGR_FRACTIONS]


def shell_edges(stars: DataFrame, scalars: DataFrame) -> DataFrame:
    """One row per snapshot with stars: `edges`, the outermost star (r, id) inside every mass fraction and inside
    the core radius in ascending order, and the mean velocity `_cx`, `_cy`, `_cz`, from the same pass.

    Bins are 1.2e-4 wide in relative radius, so even a snapshot holding a third of all rows leaves
    only a small share of them in the bins where an edge falls; fuller ones are cut further.
    """
    mass = F.col("mass_msun")
    moments = {"_m": mass, **{f"_c{a}": mass * F.col(f"v{a}_kms") for a in "xyz"}}
    found = select_at_cumulative(
        stars, SNAPSHOT, "r_pc", "mass_msun", _mass_targets, tie="object_id", per_efold=8192, sums=moments
    )
    edges = found.select(
        *SNAPSHOT,
        F.struct(
            F.col("value").alias("edge_r"),
            F.col("object_id").cast("double").alias("edge_id"),
            F.col("tag").alias("suffix"),
        ).alias("edge"),
        F.struct(*[F.try_divide(F.col(f"_c{a}"), F.col("_m")).alias(f"_c{a}") for a in "xyz"]).alias("mean"),
    )
    core = scalars.select(
        *SNAPSHOT,
        F.struct(
            (F.col("rc_nb") * F.col("rbar_pc")).alias("edge_r"),
            F.lit(float("inf")).alias("edge_id"),
            F.lit(K.LAGR_CORE).alias("suffix"),
        ).alias("edge"),
        F.lit(None).cast(edges.schema["mean"].dataType).alias("mean"),
    )
    both = edges.unionByName(core.where(F.col("edge.edge_r").isNotNull()))
    grouped = both.groupBy(*SNAPSHOT).agg(F.sort_array(F.collect_list("edge")).alias("edges"), F.max("mean").alias("mean"))
    return grouped.where(F.col("mean").isNotNull()).select(*SNAPSHOT, "edges", "mean.*")


def lagrangian_profile(singles: DataFrame, scalars: DataFrame) -> DataFrame:
    """13 metrics inside each of 18 mass fractions and the core, per snapshot.

    Every star falls into the shell ended by the first edge at or beyond it. Moments are summed
    per shell, with map-side combine, and accumulated over the 19 shells of a snapshot. A star
    beyond the last edge belongs to no shell and finds no output slot.
    """
    stars = with_radius(singles)
    # one row per snapshot, used for cutting the stars and for the output slots
    snaps = materialize(shell_edges(stars, scalars), "shell-edges")

    moved = (
        stars.join(snaps, SNAPSHOT)
        .selectExpr(
            *SNAPSHOT,
            "r_pc AS r",
            "cast(mass_msun AS double) AS m",
            "size(filter(edges, e -> e.edge_r < r_pc OR (e.edge_r = r_pc AND "
            "e.edge_id < object_id))) AS shell",
            *[f"v{a}_kms - _c{a} AS u{a}" for a in "xyz"],
            *[f"{a}_pc AS p{a}" for a in "xyz"],
        )
        .selectExpr(
            "*",
            "ux*ux + uy*uy + uz*uz AS u2",
            "coalesce(try_divide(ux*px + uy*py + uz*pz, r), 0D) AS radial",
            "coalesce(try_divide(sqrt(pow(py*uz - pz*uy, 2) + pow(pz*ux - px*uz, 2) "
            "+ pow(px*uy - py*ux, 2)), r), 0D) AS rot",
        )
    )
    shells = moved.groupBy(*SNAPSHOT, "shell").agg(
        F.expr("sum(m) AS m"),
        F.expr("cast(count(1) AS double) AS n"),
        F.expr("max(r) AS rmax"),
        *[F.expr(f"sum(m*u{a}) AS p{a}") for a in "xyz"],
        F.expr("sum(m*sqrt(u2)) AS mv"),
        F.expr("sum(m*radial) AS mr"),
        F.expr("sum(m*sqrt(greatest(u2 - radial*radial, 0D))) AS mt"),
        F.expr("sum(m*u2) AS mv2"),
        F.expr("sum(m*radial*radial) AS mr2"),
        F.expr("sum(m*rot) AS mrot"),
    )
    slots = snaps.select(*SNAPSHOT, F.posexplode("edges").alias("shell", "edge"))
    over = "OVER (PARTITION BY simulation_id, ttot ORDER BY shell ROWS UNBOUNDED PRECEDING)"
    summed = slots.join(shells, [*SNAPSHOT, "shell"], "left").selectExpr(
        *SNAPSHOT,
        "edge.suffix AS suffix",
        f"max(rmax) {over} AS rlagr",
        *[f"sum(coalesce({c}, 0D)) {over} AS {c}" for c in _MOMENTS],
    )
    inside = summed.selectExpr(
        *SNAPSHOT,
        "suffix",
        "rlagr",
        "try_divide(m, n) AS avmass",
        "cast(n AS bigint) AS nshell",
        *[f"try_divide(p{a}, m) AS v{a}" for a in "xyz"],
        "try_divide(mv, m) AS v",
        "try_divide(mr, m) AS vr",
        "try_divide(mt, m) AS vt",
        "try_divide(mv2, m) AS _v2",
        "try_divide(mr2, m) AS _r2",
        "try_divide(mrot, m) AS vrot",
    )
    # greatest() skips NULL, so an empty region needs its own branch to stay undefined
    spread = inside.selectExpr(
        "*",
        "CASE WHEN nshell > 0 THEN greatest(_v2 - (vx*vx + vy*vy + vz*vz), 0D) END AS sigma2",
        "CASE WHEN nshell > 0 THEN greatest(_r2 - vr*vr, 0D) END AS sigma_r2",
    )
    return spread.selectExpr(
        *SNAPSHOT,
        "suffix",
        *[m for m in K.LAGR_METRICS if m not in ("sigma_t2", "vrot")],
        "CASE WHEN nshell > 0 THEN greatest(sigma2 - sigma_r2, 0D) END AS sigma_t2",
        "vrot",
    )


def percent_column(suffix: str = "suffix") -> Column:
    pairs = [F.lit(x) for s in SUFFIXES for x in (s, K.percent_label(s))]
    return F.try_element_at(F.create_map(*pairs), F.col(suffix))


def append_sigma(long: DataFrame) -> DataFrame:
    """Add sigma / sigma_r / sigma_t rows: square roots of the squared dispersions.

    One pass: each squared row also yields its root.
    """
    squared = F.col("metric").isin("sigma2", "sigma_r2", "sigma_t2")
    itself = F.struct("metric", "value")
    root = F.struct(
        F.expr("substring(metric, 1, length(metric) - 1)").alias("metric"),
        F.sqrt("value").alias("value"),
    )
    both = F.when(squared, F.array(itself, root)).otherwise(F.array(itself))
    others = [c for c in long.columns if c not in ("metric", "value")]
    return long.select(*others, F.inline(both))


def profile_long(profile: DataFrame) -> DataFrame:
    """Long form of a profile: one row per suffix and metric, with the sigma rows."""
    keys = [c for c in profile.columns if c not in K.LAGR_METRICS]
    values = profile.withColumn("nshell", F.col("nshell").cast("double"))
    long = values.unpivot(keys, list(K.LAGR_METRICS), "metric", "value")
    return append_sigma(long.withColumn("percent", percent_column()))


def profile_wide(profile: DataFrame) -> DataFrame:
    """One row per snapshot with a `<metric><suffix>` column for every pair, as in lagr.7."""
    aggs = [
        F.max(F.when(F.col("suffix") == s, F.col(metric))).alias(f"{metric}{s}")
        for metric in K.LAGR_METRICS
        for s in SUFFIXES
    ]
    return profile.groupBy(*SNAPSHOT).agg(*aggs)


def total_mass(long: DataFrame, keys: list[str]) -> DataFrame:
    """Mean mass times star count of the 100 % shell, by one conditional aggregation."""
    whole = long.where(
        (F.col("percent") == "100%") & F.col("metric").isin("avmass", "nshell")
    )
    sides = whole.groupBy(*keys).agg(
        F.max(F.when(F.col("metric") == "avmass", F.col("value"))).alias("value_avmass"),
        F.max(F.when(F.col("metric") == "nshell", F.col("value"))).alias("value_nshell"),
    )
    both = sides.where(F.col("value_avmass").isNotNull() & F.col("value_nshell").isNotNull())
    return both.withColumn("total_mass", F.col("value_avmass") * F.col("value_nshell"))


def initial_total_mass(long: DataFrame, time: str) -> DataFrame:
    """Total mass at time zero, per simulation. More or fewer than one such row is an error."""
    zero = total_mass(long, ["simulation_id", time]).where(F.col(time) == 0.0)
    out = zero.groupBy("simulation_id").agg(
        F.max("total_mass").alias("initial_total_mass_msun"), F.count(F.lit(1)).alias("_n")
    )
    checked = F.when(F.col("_n") == 1, F.col("initial_total_mass_msun")).otherwise(
        F.raise_error(F.lit("expected exactly one total-mass row at time 0")).cast("double")
    )
    return out.select("simulation_id", checked.alias("initial_total_mass_msun"))
