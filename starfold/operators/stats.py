"""Histograms, axis ranges and point filters behind the figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starfold import constants as K
from starfold.functions import display
from starfold.operators.ordered import percentiles
from starfold.operators.snapshot import SNAPSHOT
from starfold.session import materialize


def _finite(name: str) -> Column:
    c = F.col(name).cast("double")
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def axis_range(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = SNAPSHOT) -> DataFrame:
    """Minimum and maximum per plotted column."""
    aggs = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(*keys).agg(*aggs)


def _bin_index(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin 0..bins-1; the upper edge belongs to the last bin."""
    cell = F.floor((value - low) / (high - low) * bins)
    return F.when(high > low, F.least(cell, F.lit(bins - 1))).otherwise(0).cast("int")


def histogram(
    df: DataFrame,
    columns: Sequence[str],
    *,
    keys: Sequence[str] = SNAPSHOT,
    bins: int = 100,
    log: Sequence[bool] | None = None,
) -> DataFrame:
    """Counts on a grid of equal bins over each column's own range, one or two dimensions.

    Logarithmic axes use log10 and leave out non-positive values.
    """
    log = log or [False] * len(columns)
    points = df
    for c, is_log in zip(columns, log):
        points = points.where((F.col(c) > 0) & _finite(c) if is_log else _finite(c))
    shown = [
        (F.log10(c) if is_log else F.col(c).cast("double")).alias(f"_v{i}")
        for i, (c, is_log) in enumerate(zip(columns, log))
    ]
    points = points.select(*keys, *shown)
    axes = [f"_v{i}" for i in range(len(columns))]
    ranges = points.groupBy(*keys).agg(
        *[f(a).alias(f"{n}{a}") for a in axes for n, f in (("lo", F.min), ("hi", F.max))]
    )
    # a written table has an exact size, so Spark can broadcast it instead of shuffling the points
    ranges = materialize(ranges, "axis-ranges")
    binned = points.join(ranges, list(keys)).select(
        *keys,
        *[
            _bin_index(F.col(a), F.col(f"lo{a}"), F.col(f"hi{a}"), bins).alias(f"bin_{i}")
            for i, a in enumerate(axes)
        ],
    )
    cells = [f"bin_{i}" for i in range(len(columns))]
    return binned.groupBy(*keys, *cells).agg(F.count(F.lit(1)).alias("n"))


def percentile_limits(
    df: DataFrame,
    columns: Sequence[str],
    *,
    keys: Sequence[str] = SNAPSHOT,
    percents: tuple[float, float] = (0.1, 99.9),
    point: DataFrame | None = None,
) -> DataFrame:
    """Axis limits from exact percentiles, widened to keep a marked point in view.

    A point outside the range moves the limit 5 % of the range beyond the point.
    """
    keys = list(keys)
    finite = df
    for c in columns:
        finite = finite.where(_finite(c))
    # all columns in one pass: a column name is one more grouping key
    tall = finite.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        keys, list(columns), "_column", "_value"
    )
    pct = percentiles(tall, [*keys, "_column"], "_value", percents)
    out = pct.groupBy(*keys).agg(
        *[
            F.max(
                F.when((F.col("_column") == c) & (F.col("pct") == float(p)), F.col("value"))
            ).alias(f"{c}_{side}")
            for c in columns
            for side, p in zip(("low", "high"), percents)
        ]
    )
    if point is None:
        return out
    marks = point.select(*keys, *[F.col(c).alias(f"_at_{c}") for c in columns])
    out = out.join(marks, keys, "left")
    for c in columns:
        low, high, at = F.col(f"{c}_low"), F.col(f"{c}_high"), F.col(f"_at_{c}")
        pad = 0.05 * (high - low)
        out = out.withColumns(
            {f"{c}_low": F.least(low, at - pad), f"{c}_high": F.greatest(high, at + pad)}
        )
    return out.drop(*[f"_at_{c}" for c in columns])


def display_attributes(singles: DataFrame, keys: Sequence[str] = SNAPSHOT) -> DataFrame:
    """Opacity, circle radius and marker size of every star in its snapshot."""
    ranges = singles.groupBy(*keys).agg(
        F.min("luminosity_lsun").alias("_lo"), F.max("luminosity_lsun").alias("_hi")
    )
    ranges = materialize(ranges, "luminosity-ranges")
    return singles.join(ranges, list(keys)).select(
        *keys,
        "object_id",
        display.luminosity_alpha("luminosity_lsun", "_lo", "_hi").alias("alpha"),
        display.mass_radius("mass_msun").alias("display_radius"),
        display.marker_size("radius_rsun").alias("marker_size"),
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def compact_pairs(df: DataFrame) -> DataFrame:
    """Events whose two stars are both compact objects."""
    return df.where(
        F.col("primary_kw").isin(*K.COMPACT_KW) & F.col("secondary_kw").isin(*K.COMPACT_KW)
    )


def bh_pairs(df: DataFrame) -> DataFrame:
    return df.where((F.col("primary_kw") == K.BH_KW) & (F.col("secondary_kw") == K.BH_KW))
