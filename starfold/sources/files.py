"""Which snapshot files to read: catalogue, selection, gaps and overlaps."""

from __future__ import annotations

import os
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from starfold.functions.numeric import on_grid
from starfold.operators.history import first_row
from starfold.operators.ordered import percentiles, previous_value

_TIME = r"snap\.40_([0-9.eE+-]+?)\.h5part$"


def file_catalog(spark: SparkSession, root: str, glob: str = "*.h5part") -> DataFrame:
    """Path, size, mtime, run directory and file-name time; the content column is never read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
    )
    return describe_files(
        files.select(
            "path",
            F.col("length").alias("size_bytes"),
            F.unix_micros("modificationTime").cast("double").alias("_us"),
        ).select("path", "size_bytes", (F.col("_us") / 1e6).alias("mtime"))
    )


def describe_files(files: DataFrame) -> DataFrame:
    return files.withColumns(
        {
            "filename_time": F.regexp_extract("path", _TIME, 1).try_cast("double"),
            "run_dir": F.regexp_extract("path", r"^(.*)/[^/]*$", 1),
        }
    )


def judged_files(
    catalog: DataFrame,
    *,
    now: float,
    wait_age_hour: float = 24,
    every: float | None = 1.0,
    exclude_bad: bool = True,
) -> DataFrame:
    """The catalogue with `left_out`: why a file is not read, NULL for those that are.

    Reasons in this order: too new, in a folder called bad, no time in the name, smaller than another file of
    the same time (equal sizes: the first path stays), not on the time grid.
    """
    parent = F.lower(F.regexp_extract("run_dir", r"([^/]*)$", 1))
    plain = (
        F.when(F.col("mtime") > F.lit(float(now) - 3600.0 * wait_age_hour), "too new")
        .when(F.lit(exclude_bad) & parent.contains("bad"), "bad folder")
        .when(F.col("filename_time").isNull(), "no time in the name")
    )
    marked = catalog.withColumn("left_out", plain)
    able = marked.where(F.col("left_out").isNull()).select("path", "filename_time", "size_bytes")
    one = first_row(able, ["filename_time"], F.desc("size_bytes"), "path")
    one = one.select("path", on_grid("filename_time", every).alias("_on_grid"))
    late = F.when(F.col("_on_grid").isNull(), "another file of this time is larger").when(
        ~F.col("_on_grid"), "off the time grid"
    )
    return (
        marked.join(one, "path", "left")
        .withColumn("left_out", F.coalesce("left_out", late))
        .select(*catalog.columns, "left_out")
    )


def select_files(catalog: DataFrame, **rules: Any) -> DataFrame:
    """The files that `judged_files` leaves none out of."""
    return judged_files(catalog, **rules).where(F.col("left_out").isNull()).drop("left_out")


def missing_times(selected: DataFrame, every: float, chunk_width: float = 4096.0) -> DataFrame:
    """Grid times between selected files that have no file (spacing off by more than 10 %)."""
    times = selected.select(F.lit(0).alias("_all"), "filename_time").distinct()
    gaps = previous_value(
        times, ["_all"], "filename_time", chunk_width=chunk_width * every, out="before"
    )
    step = F.col("filename_time") - F.col("before")
    wide = gaps.where(F.abs(step - every) > 0.1 * every)
    count = F.round(step / every).cast("int") - 1
    between = F.transform(
        F.sequence(F.lit(1), count), lambda k: F.col("before") + k * F.lit(float(every))
    )
    return wide.where(count > 0).select(F.explode(between).alias("missing_time"))


def duplicate_times(catalog: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Files whose time also occurs in another run directory, one row per file."""
    keys = keys or []
    tick = F.round(F.col("filename_time") / 1e-9).cast("bigint")
    marked = catalog.withColumn("_tick", tick)
    shared = (
        marked.groupBy(*keys, "_tick")
        .agg(F.count_distinct("run_dir").alias("n_dirs"), F.count(F.lit(1)).alias("n_files"))
        .where(F.col("n_dirs") > 1)
    )
    return marked.join(shared, [*keys, "_tick"]).drop("_tick")


def directory_overlaps(
    files: DataFrame, keys: list[str] | None = None, bucket: float = 1024.0
) -> DataFrame:
    """Pairs of run directories whose file-time ranges overlap.

    Ranges are cut into buckets and joined on them; a pair is reported only in the first bucket
    both ranges reach, so it appears once.
    """
    keys = keys or []
    ranges = files.groupBy(*keys, "run_dir").agg(
        F.min("filename_time").alias("lo"), F.max("filename_time").alias("hi")
    )
    cut = ranges.withColumn("_from", F.floor(F.col("lo") / bucket))
    cut = cut.withColumn(
        "_bucket", F.explode(F.sequence("_from", F.floor(F.col("hi") / bucket)))
    )
    left = cut.withColumnsRenamed({c: f"{c}_a" for c in ("run_dir", "lo", "hi", "_from")})
    right = cut.withColumnsRenamed({c: f"{c}_b" for c in ("run_dir", "lo", "hi", "_from")})
    pairs = left.join(right, [*keys, "_bucket"]).where(
        (F.col("run_dir_a") < F.col("run_dir_b"))
        & (F.col("lo_a") <= F.col("hi_b"))
        & (F.col("lo_b") <= F.col("hi_a"))
        & (F.col("_bucket") == F.greatest("_from_a", "_from_b"))
    )
    return pairs.select(
        *keys,
        "run_dir_a",
        "run_dir_b",
        F.greatest("lo_a", "lo_b").alias("overlap_lo"),
        F.least("hi_a", "hi_b").alias("overlap_hi"),
    )


def shared_snapshots(overlaps: DataFrame, steps: DataFrame) -> DataFrame:
    """Snapshots that both directories of an overlapping pair really contain."""
    have = steps.select("run_dir", "ttot").distinct()
    left = overlaps.select("run_dir_a", "run_dir_b").join(
        have.withColumnRenamed("run_dir", "run_dir_a"), "run_dir_a"
    )
    return left.join(
        have.withColumnRenamed("run_dir", "run_dir_b"), ["run_dir_b", "ttot"], "left_semi"
    ).select("run_dir_a", "run_dir_b", "ttot")


def spacing_gaps(files: DataFrame, keys: list[str], chunk_width: float = 4096.0) -> DataFrame:
    """File-time gaps wider than 1.5 times the median spacing."""
    times = files.select(*keys, "filename_time").distinct()
    steps = previous_value(
        times, keys, "filename_time", chunk_width=chunk_width, out="before"
    ).where(F.col("before").isNotNull())
    steps = steps.withColumn("gap", F.col("filename_time") - F.col("before"))
    typical = percentiles(steps, keys, "gap", [50.0]).select(
        *keys, F.col("value").alias("typical_gap")
    )
    return steps.join(typical, keys).where(F.col("gap") > 1.5 * F.col("typical_gap"))


def preflight_totals(steps: DataFrame) -> DataFrame:
    """Files, bytes, estimated rows and time range per simulation."""
    per_file = steps.groupBy("simulation_id", "source_hdf5_path").agg(
        F.max("size_bytes").alias("size_bytes"),
        F.sum("n_star").alias("n_star"),
        F.min("ttot").alias("lo"),
        F.max("ttot").alias("hi"),
    )
    return per_file.groupBy("simulation_id").agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("size_bytes").alias("total_bytes"),
        F.sum("n_star").alias("estimated_row_count"),
        F.min("lo").alias("ttot_min"),
        F.max("hi").alias("ttot_max"),
    )


def first_job_id(simulation_dir: str) -> int:
    """Smallest all-digit directory name below a simulation folder."""
    jobs = [int(e.name) for e in os.scandir(simulation_dir) if e.is_dir() and e.name.isdigit()]
    if not jobs:
        raise FileNotFoundError(f"no numbered job directory in {simulation_dir}")
    return min(jobs)
