"""As-of join of two tables: for every asking row the last, next or nearest row of its key.

Both sides are merged and range-partitioned by key and time, so a key with a third of all rows is spread over
many tasks. Windows run inside (key, range) only. What a range can't see, the last or next row of an earlier or
later range, is carried over in a table of at most two rows per range: only the first and the last key of a
range can have rows in another one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from starfold.session import materialize

DIRECTIONS = ("backward", "forward", "nearest")


def _fresh(name: str, taken: Sequence[str]) -> str:
    while name in taken:
        name += "_"
    return name


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    on: str,
    *,
    direction: str = "backward",
    allow_equal: bool = True,
    tie: Sequence[str] = (),
    out: str = "found",
) -> DataFrame:
    """All rows of `left` with the struct `out`: the row of `right` found for each, NULL where there is none.

    backward takes the last row at or before the asked time, forward the first at or after it, nearest the nearer
    of both (of two equally near the earlier one). Without `allow_equal`, which nearest does not offer, rows of
    the asked time itself don't count. Among rows of `right` with equal key and time, `tie` orders: backward takes the last, forward the
    first. Rows with a NULL key or time find nothing and are never found.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {DIRECTIONS}, not {direction!r}")
    if direction == "nearest" and not allow_equal:
        raise ValueError("the nearest row may be one of the asked time itself")
    if not keys:
        raise ValueError("an as-of join needs at least one key column")
    keys = list(keys)
    usable = F.col(on).isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    key = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    part_key = [f"_k{i}" for i in range(len(keys))]
    found_type, asked_type = right.select(F.struct(*right.columns).alias("r")), left.select(F.struct(*left.columns).alias("l"))
    no_right = F.lit(None).cast(found_type.schema["r"].dataType)
    no_left = F.lit(None).cast(asked_type.schema["l"].dataType)
    # an asking row stands behind the rows of its own time if they count backward, before them otherwise
    behind = allow_equal == (direction != "forward")
    ties = F.struct(*[F.col(c) for c in tie]) if tie else F.struct(F.lit(0).alias("none"))
    no_tie = F.lit(None).cast(right.select(ties.alias("t")).schema["t"].dataType)
    asked = left.select(
        *key, F.col(on).alias("_t"), F.lit(2 if behind else 0).alias("_o"), no_tie.alias("_tie"),
        F.xxhash64(*left.columns).alias("_h"), F.struct(*left.columns).alias("l"), no_right.alias("r"),
        usable.alias("_usable"),
    )
    offered = right.where(usable).select(
        *key, F.col(on).alias("_t"), F.lit(1).alias("_o"), ties.alias("_tie"),
        F.lit(0).cast("bigint").alias("_h"), no_left.alias("l"), F.struct(*right.columns).alias("r"),
        F.lit(True).alias("_usable"),
    )
    both = asked.unionByName(offered)
    order = ["_t", "_o", "_tie", "_h"]
    placed = materialize(
        both.repartitionByRange(*part_key, *order).withColumn("_part", F.spark_partition_id()), "asof-ranges"
    )
    carried = _carried(placed, part_key, order)
    inside = W.partitionBy(*part_key, "_part").orderBy(*order)
    before = F.last("r", ignorenulls=True).over(inside.rowsBetween(W.unboundedPreceding, 0))
    after = F.first("r", ignorenulls=True).over(inside.rowsBetween(0, W.unboundedFollowing))
    wanted = {"backward": {"_b": before}, "forward": {"_f": after}, "nearest": {"_b": before, "_f": after}}[direction]
    seen = placed.withColumns(wanted).where(F.col("l").isNotNull())
    same = [F.col(k).eqNullSafe(F.col(f"c{k}")) for k in part_key]
    joined = seen.join(carried, [*same, F.col("_part") == F.col("c_part")], "left")
    result: Column
    past = F.coalesce("_b", "_earlier") if "_b" in wanted else None
    future = F.coalesce("_f", "_later") if "_f" in wanted else None
    if past is not None and future is not None:
        gap_past = F.col("_t") - past[on]
        gap_future = future[on] - F.col("_t")
        result = F.when(past.isNull() | (gap_future < gap_past), F.coalesce(future, past)).otherwise(past)
    else:
        result = past if past is not None else future
    return joined.select(
        *[F.col("l")[c].alias(c) for c in left.columns],
        F.when(F.col("_usable"), result).alias(_fresh(out, left.columns)),
    )


def _carried(placed: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """(ckeys, c_part, _earlier, _later): the last row of earlier ranges and the first of later ones, for
    keys at the edges of ranges."""
    struct = F.struct(*key)
    edges = placed.groupBy("_part").agg(F.min(struct).alias("a"), F.max(struct).alias("z"))
    edge_keys = materialize(
        edges.select(F.explode(F.array("a", "z")).alias("k")).select("k.*").distinct(), "asof-edge-keys"
    )
    same = [placed[k].eqNullSafe(edge_keys[k]) for k in key]
    rows = placed.join(edge_keys, same, "left_semi")
    place = F.struct(*order)
    held = F.when(F.col("r").isNotNull(), place)
    ranges = rows.groupBy(*key, "_part").agg(
        F.max_by("r", held).alias("_last"), F.min_by("r", held).alias("_first")
    )
    by_key = W.partitionBy(*key).orderBy("_part")
    out = ranges.select(
        *[F.col(k).alias(f"c{k}") for k in key],
        F.col("_part").alias("c_part"),
        F.last("_last", ignorenulls=True).over(by_key.rowsBetween(W.unboundedPreceding, -1)).alias("_earlier"),
        F.first("_first", ignorenulls=True).over(by_key.rowsBetween(1, W.unboundedFollowing)).alias("_later"),
    )
    return materialize(out, "asof-carried")
