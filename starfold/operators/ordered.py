"""Order statistics and running aggregates that never put one whole key into one task.

A window over a snapshot would sort every row of that snapshot in a single task. The helpers here
first aggregate rows into order-preserving bins (or chunks), run the window over the few bins, and
go back only to the rows of the bins that matter.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from starfold.functions.numeric import order_bin
from starfold.session import materialize

# Rows of one bucket that are sorted exactly, and slices that a fuller one is cut into.
BUCKET_ROWS = 100_000
SLICES = 4096
# Bin of rows without a value, before all others.
NO_VALUE = -(1 << 62)

# Targets of a key as (tag, cumulative weight) expressions of the key's total weight.
Targets = Callable[[Column], list[tuple[Column, Column]]]


def _running(bins: DataFrame, part: Sequence[str], *order: str) -> DataFrame:
    """Running weight up to (_cum) and before (_before) every row, and whether it is the last."""
    spec = W.partitionBy(*part).orderBy(*order)
    out = bins.withColumn(
        "_cum", F.sum("_w").over(spec.rowsBetween(W.unboundedPreceding, 0))
    )
    return out.withColumns(
        {
            "_before": F.coalesce(F.lag("_cum").over(spec), F.lit(0.0)),
            "_last": F.lead(F.lit(1)).over(spec).isNull(),
        }
    )


def _reached(target: Column, before: Column, cum: Column) -> Column:
    """Does the target fall on this row? One missed by rounding belongs to the last row."""
    return (target > before) & ((target <= cum) | F.col("_last"))


def _summed(level: DataFrame, part: list[str], tie: str | None, sums: Sequence[str] = ()) -> DataFrame:
    """Weight, rows and the ranges of value and tie of every bucket."""
    ids = [F.min(tie).alias("_tlo"), F.max(tie).alias("_thi")] if tie else []
    return level.groupBy(*part).agg(
        F.sum("_w").alias("_w"), F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
        *ids, *[F.sum(c).alias(c) for c in sums],
    )


def _hit(sums: DataFrame, hit: DataFrame, part: list[str], kept: Sequence[str]) -> DataFrame:
    """Targets of `hit` on the rows of `sums` (running weights inside `part`) that they fall on."""
    targets = hit.select(*part, "_base", "tag", "target", *kept)
    before, cum = F.col("_base") + F.col("_before"), F.col("_base") + F.col("_cum")
    return (
        sums.join(targets, part)
        .where(_reached(F.col("target"), before, cum))
        .withColumn("_base", before)
    )


def _splittable(tie: str | None) -> Column:
    wide = F.col("_hi") > F.col("_lo")
    return wide | (F.col("_thi") > F.col("_tlo")) if tie else wide


def _slice(tie: str | None) -> Column:
    """One of 4096 slices of a bucket: of its values, or of its ties where all values are equal."""
    span = F.col("_hi") - F.col("_lo")
    out = F.when(span > 0, F.floor((F.col("_v") - F.col("_lo")) / span * SLICES))
    if tie:
        ids = F.col("_thi") - F.col("_tlo")
        out = out.when(ids > 0, F.floor((F.col(tie) - F.col("_tlo")) / ids * SLICES))
    return F.coalesce(out, F.lit(0)).cast("bigint")


def select_at_cumulative(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str | Column,
    targets: Targets,
    *,
    tie: str | None = None,
    per_efold: int = 1024,
    refine: bool = False,
    bound: int = BUCKET_ROWS,
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """First `value` (ascending, per key) at which the running weight reaches each target.

    Returns keys, tag, target, value and `weight_before`, the weight ahead of that row; with `tie` (a number),
    equal values are ordered by that column and it is returned too. `sums` are further expressions whose totals
    per key are returned with every row; they come from the first pass over the rows.

    The first histogram has `per_efold` bins per factor e. A bucket that a target falls on and that has more than
    `bound` rows is cut into slices of its range of values, or of ties where all values are equal, until none has
    more, or its rows are equal in both. So the exact step sorts at most `bound` rows of a bucket, whatever their
    values. `refine` cuts once in any case.
    """
    keys = list(keys)
    extra = dict(sums or {})
    order = ["_v", *([tie] if tie else [])]
    weight = F.col(weight) if isinstance(weight, str) else weight
    level = rows if extra else rows.where(F.col(value).isNotNull())
    # rows without a value count in the sums only: their bin comes first and has no weight
    level = level.select(
        *keys,
        *([tie] if tie else []),
        F.col(value).cast("double").alias("_v"),
        F.when(F.col(value).isNotNull(), weight.cast("double")).otherwise(0.0).alias("_w"),
        order_bin(value, per_efold).alias("_b"),
        *[c.alias(name) for name, c in extra.items()],
    )
    if extra:
        level = level.withColumn("_b", F.when(F.col("_v").isNull(), NO_VALUE).otherwise(F.col("_b")))
    part = [*keys, "_b"]
    every = W.partitionBy(*keys)
    bins = _running(_summed(level, part, tie, list(extra)), keys, "_b").withColumns(
        {"_total": F.sum("_w").over(every), **{c: F.sum(c).over(every) for c in extra}}
    )
    wanted = [
        (F.struct(tag.alias("tag"), target.alias("target")),
         _reached(target, F.col("_before"), F.col("_cum")))
        for tag, target in targets(F.col("_total"))
    ]
    any_hit = reduce(lambda a, b: a | b, [test for _, test in wanted])
    found = F.array_compact(F.array(*[F.when(test, entry) for entry, test in wanted]))
    ranges = ["_n", "_lo", "_hi", *(["_tlo", "_thi"] if tie else [])]
    hit = bins.where(any_hit & F.col("_lo").isNotNull()).select(
        *part, *ranges, F.col("_before").alias("_base"), *extra, F.inline(found)
    )
    level = level.drop(*extra)
    # a few rows per key, needed by two branches of the next level
    hit = materialize(hit, "hit-bins")
    limit = 0 if refine else bound
    while not hit.where((F.col("_n") > limit) & _splittable(tie)).isEmpty():
        edges = hit.select(*part, *ranges).distinct()
        cut = F.when(F.col("_n") > limit, _slice(tie)).otherwise(F.lit(0).cast("bigint"))
        name = f"_s{len(part) - len(keys)}"
        level = level.join(edges, part).select(*part, cut.alias(name), *order, "_w")
        level = materialize(level, "hit-rows")
        counted = _running(_summed(level, [*part, name], tie), part, name)
        fell = _hit(counted, hit.select(*part, "_base", "tag", "target", *extra), part, list(extra))
        part = [*part, name]
        hit = materialize(fell.select(*part, *ranges, "_base", "tag", "target", *extra), "hit-cells")
        limit = bound
    slim = (
        level.join(hit.select(*part).distinct(), part, "left_semi").groupBy(*part, *order).agg(F.sum("_w").alias("_w"))
    )
    exact = _hit(_running(slim, part, *order), hit, part, list(extra))
    return exact.select(
        *keys,
        "tag",
        "target",
        F.col("_v").alias("value"),
        F.col("_base").alias("weight_before"),
        *([tie] if tie else []),
        *extra,
    )


def percentiles(
    rows: DataFrame, keys: Sequence[str], value: str, percents: Sequence[float]
) -> DataFrame:
    """Exact linearly interpolated percentiles per key, one row per key and percent."""

    def ranks(total: Column) -> list[tuple[Column, Column]]:
        """The two order statistics around each percentile position, and where it lies between."""
        out = []
        for p in percents:
            pos = F.lit(float(p) / 100.0) * (total - 1.0)
            for side, rank in ((0, F.floor(pos)), (1, F.ceil(pos))):
                tag = F.struct(
                    F.lit(float(p)).alias("pct"),
                    F.lit(side).alias("side"),
                    (pos - F.floor(pos)).alias("share"),
                )
                out.append((tag, (rank + 1.0).cast("double")))
        return out

    picked = select_at_cumulative(
        rows, keys, value, F.lit(1.0), ranks, per_efold=256
    )
    sides = picked.groupBy(*keys, F.col("tag.pct").alias("pct")).agg(
        F.max(F.when(F.col("tag.side") == 0, F.col("value"))).alias("_a"),
        F.max(F.when(F.col("tag.side") == 1, F.col("value"))).alias("_b"),
        F.max("tag.share").alias("_share"),
    )
    between = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_share")
    return sides.select(*keys, "pct", between.alias("value"))


def running_max(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    chunk: Sequence[str],
    within: str,
    out: str = "running_max",
) -> DataFrame:
    """Running maximum of `value` per key in (chunk, within) order.

    `chunk` columns cut the order into bounded pieces, such as a file split or a range of row
    numbers: one window runs over the chunk maxima, another inside each chunk.
    """
    part = [*keys, *chunk]
    earlier = W.orderBy(*chunk) if not keys else W.partitionBy(*keys).orderBy(*chunk)
    tops = rows.groupBy(*part).agg(F.max(value).alias("_top"))
    tops = tops.select(
        *part,
        F.max("_top").over(earlier.rowsBetween(W.unboundedPreceding, -1)).alias("_earlier"),
    )
    inside = W.partitionBy(*part).orderBy(within).rowsBetween(W.unboundedPreceding, 0)
    return (
        rows.join(tops, part)
        .withColumn(out, F.greatest(F.max(value).over(inside), F.col("_earlier")))
        .drop("_earlier")
    )


def previous_value(
    rows: DataFrame, keys: Sequence[str], order: str, *, chunk_width: float, out: str
) -> DataFrame:
    """The next lower distinct `order` value per key, NULL for the first.

    Cuts the order axis into ranges of `chunk_width`; the first row of a range takes the highest
    value of the nearest earlier range. Rows must be distinct on (keys, order).
    """
    part = [*keys, "_chunk"]
    cut = rows.withColumn("_chunk", F.floor(F.col(order) / F.lit(float(chunk_width))))
    tops = cut.groupBy(*part).agg(F.max(order).alias("_top"))
    spec = W.partitionBy(*keys).orderBy("_chunk")
    tops = tops.select(*part, F.lag("_top").over(spec).alias("_earlier"))
    lag = F.lag(order).over(W.partitionBy(*part).orderBy(order))
    return (
        cut.join(tops, part)
        .withColumn(out, F.coalesce(lag, F.col("_earlier")))
        .drop("_chunk", "_earlier")
    )


def running_sums(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, Column]
) -> DataFrame:
    """The rows with the running sum of each of `sums` per key, up to and with each row, in the order of `order`.

    A prefix scan: rows are range-partitioned by key and order, summed per range, and every range starts from the sum
    of the key's earlier ranges. Windows see the rows of one range, or one row per range, never a whole key.
    Rows must be distinct on (keys, order); with F.lit(1) the sum is the row's number.
    """
    keys = list(keys)
    placed = materialize(
        rows.withColumns({f"_add_{n}": c for n, c in sums.items()})
        .repartitionByRange(*keys, *order)
        .withColumn("_range", F.spark_partition_id()),
        "scan-ranges",
    )
    part = [*keys, "_range"]
    totals = placed.groupBy(*part).agg(*[F.sum(f"_add_{n}").alias(f"_sum_{n}") for n in sums])
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(*part, *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_from_{n}") for n in sums])
    inside = W.partitionBy(*part).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    out = placed.join(materialize(starts, "scan-starts"), part)
    found = {n: F.sum(f"_add_{n}").over(inside) + F.col(f"_from_{n}") for n in sums}
    return out.select(*rows.columns, *[c.alias(n) for n, c in found.items()])
