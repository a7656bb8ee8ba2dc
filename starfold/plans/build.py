"""Incremental feature builds: which files to read, shared reads, commits per batch of files."""

from __future__ import annotations

import time
from collections import defaultdict
from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from starfold.functions.numeric import on_grid
from starfold.operators import binaries as pairs
from starfold.operators import compact, galactic, imbh, lagrangian, snapshot
from starfold.operators.dedup import step_winners
from starfold.operators.lake_tables import lake_tables, raw_names, raw_steps
from starfold.plans.store import COMPACT_AFTER, FeatureStore
from starfold.schema.registry import LAKE_TABLES, TABLES, table_schema
from starfold.session import drop_work, work_path
from starfold.sources.files import describe_files, judged_files
from starfold.sources.h5part import H5PartDataSource, raw_columns

Tables = dict[str, DataFrame]
_KINDS = ("lake", "source")
_STEPS = "snapshot_step_index"
# Stored with every build: files that were not read, and why.
LEFT_OUT = "files_left_out"


@dataclass(frozen=True)
class ScanOptions:
    """How a simulation's files are scanned; only some options define the result."""

    force: bool = False
    wait_age_hour: float = 24
    sample_every_nb_time: float | None = 1.0
    exclude_bad_dirname: bool = True
    incremental_from_cache_tail: bool = True
    checkpoint_every_files: int | None = 100
    skip_unreadable_files: bool = False

    def persisted(self) -> dict[str, Any]:
        """Options whose change forces a rebuild."""
        ignored = ("force", "checkpoint_every_files", "skip_unreadable_files")
        return {k: v for k, v in asdict(self).items() if k not in ignored}


@dataclass(frozen=True)
class Feature:
    """A table computed from snapshots.

    `build` maps the lake tables of a set of files to rows. A dataset is replaced per source
    file, a table per snapshot. Kind 'source' features are the lake tables themselves.
    """

    name: str
    build: Callable[[Tables], DataFrame]
    dataset: bool = False
    kind: str = "lake"
    schema_version: int = 1
    tables: tuple[str, ...] = ("scalars", "singles", "binaries")
    needs_primordial: bool = False
    # lake columns that `build` reads of a table; all of a table without an entry
    columns: Mapping[str, tuple[str, ...]] = field(default_factory=dict, hash=False)

    @property
    def key(self) -> str:
        """What a commit replaces: the rows of a source file or those of a snapshot."""
        return "source_hdf5_path" if self.dataset else "ttot"

    def __post_init__(self) -> None:
        if self.kind not in _KINDS:
            raise ValueError(f"{self.name}: kind must be one of {_KINDS}")

    def meta(self, options: ScanOptions) -> dict[str, Any]:
        return {
            "table_name": self.name,
            "schema_version": self.schema_version,
            "schema_hash": table_schema(self.name).hash() if self.name in TABLES else None,
            "scan_options": options.persisted(),
        }


def stellar_type_feature(stellar_type: str | None = None, kw: int | None = None) -> Feature:
    """Pairs containing one stellar type."""
    code = pairs.stellar.resolve_kw(stellar_type, kw)
    return Feature(
        f"binary_stellar_type_{code}",
        lambda t: pairs.with_stellar_type(t["binaries"], kw=code),
        tables=("scalars", "binaries"),
    )


def _orbit(t: Tables) -> DataFrame:
    by_file = t["scalars"].withColumns(
        {
            "source_file_time": F.regexp_extract(
                "source_hdf5_path", r"snap\.40_([0-9.eE+-]+?)\.h5part$", 1
            ).try_cast("double"),
            "source_row_index": F.col("ttot"),
        }
    )
    return galactic.orbit_points(by_file)


def _primordial(t: Tables) -> DataFrame:
    return pairs.primordial_binaries(t["binaries"])


_VELOCITY = ("vx_kms", "vy_kms", "vz_kms")

FEATURES: dict[str, Feature] = {
    f.name: f
    for f in (
        *[
            Feature(n, lambda t, n=n: t[n.removeprefix("snapshot_")], True, "source",
                    2 if n == "snapshot_scalars" else 1, ("scalars", n.removeprefix("snapshot_")))
            for n in LAKE_TABLES
        ],
        Feature(
            "compact_object_history",
            lambda t: compact.compact_object_history(t["singles"], t["binaries"], t["scalars"]),
            dataset=True,
            columns={
                "singles": ("object_id", "kw", "mass_msun", "r_pc", *_VELOCITY),
                "binaries": (
                    *(f"{c}_{i}" for c in ("object_id", "kw") for i in (1, 2)), "mass_1_msun", "mass_2_msun", "cm_id", "r_pc",
                    "semi_major_axis_au", "eccentricity", *(f"cm_{a}_pc" for a in "xyz"), *(f"cm_{v}" for v in _VELOCITY),
                ),
            },
        ),
        Feature(
            "snapshot_summary",
            lambda t: snapshot.snapshot_summary(t["scalars"], t["singles"], t["binaries"]),
        ),
        Feature(
            "current_lagrangian",
            lambda t: lagrangian.lagrangian_profile(t["singles"], t["scalars"]),
            tables=("scalars", "singles"),
            columns={"singles": ("object_id", "mass_msun", "r_pc", *_VELOCITY)},
        ),
        Feature(
            "compact_binary_count",
            lambda t: compact.compact_binary_hits(t["binaries"], t["scalars"]),
            tables=("scalars", "binaries"),
            columns={"binaries": ("object_id_1", "object_id_2", "kw_1", "kw_2")},
        ),
        Feature("primordial_binary", _primordial, tables=("scalars", "binaries")),
        Feature("galactic_orbit", _orbit, tables=("scalars",)),
        Feature(
            "intermediate_mass_black_hole",
            lambda t: imbh.imbh_sightings(t["singles"], t["binaries"], t["scalars"]),
            schema_version=2,
        ),
        Feature(
            "b_type_binary",
            lambda t: pairs.b_type_binaries(t["binaries"], t["primordial"]),
            tables=("scalars", "binaries"),
            needs_primordial=True,
        ),
    )
}
GROUPS = {
    "pilot": ("compact_object_history", "snapshot_summary"),
    "lake": LAKE_TABLES,
}


def expand_features(names: Iterable[str]) -> list[str]:
    """Feature names with groups resolved, in order, without repeats."""
    out: dict[str, None] = {}
    for name in names:
        for member in GROUPS.get(name, (name,)):
            if member not in FEATURES:
                raise ValueError(f"unknown feature {member!r}; known: {sorted(FEATURES)}")
            out[member] = None
    return list(out)


def files_to_process(
    catalog: DataFrame,
    manifest: DataFrame,
    *,
    tail_only: bool = True,
    winners: DataFrame | None = None,
) -> DataFrame:
    """Files a feature still has to read.

    A processed file with unchanged mtime is fresh. With `tail_only`, processed files before the
    last processed one are not looked at again; never processed files always are. `winners`
    (source_hdf5_path, ttot) names the snapshots each file stands for now: processed files whose
    stored snapshots differ, because another file has won or lost them since, are read again too.
    """
    done = manifest.select(
        F.col("source_hdf5_path").alias("path"), F.col("mtime").alias("_seen"), F.col("ttot").alias("_had")
    )
    marked = catalog.join(done, "path", "left")
    last = marked.where(F.col("_seen").isNotNull()).agg(F.max("filename_time")).first()[0]
    fresh = F.coalesce(F.abs(F.col("_seen") - F.col("mtime")) <= 1e-9, F.lit(False))
    wanted = ~fresh
    if tail_only and last is not None:
        wanted = wanted & (F.col("_seen").isNull() | (F.col("filename_time") >= last))
    if winners is not None:
        now = winners.groupBy(F.col("source_hdf5_path").alias("path")).agg(
            F.sort_array(F.collect_set("ttot")).alias("_now")
        )
        marked = marked.join(now, "path", "left")
        none = F.array().cast("array<double>")
        same = F.sort_array(F.coalesce("_had", none)) == F.coalesce("_now", none)
        wanted = wanted | (F.col("_seen").isNotNull() & fresh & ~same)
    return marked.where(wanted).select(*catalog.columns)


@dataclass
class Job:
    simulation_id: str
    feature: Feature
    options: ScanOptions = field(default_factory=ScanOptions)


class Builder:
    """Runs feature jobs; jobs with equal simulation and options share every file read."""

    def __init__(
        self,
        store: FeatureStore,
        roots: dict[str, str],
        opener: str | None = None,
        now: Callable[[], float] = time.time,
        slice_bytes: int | None = None,
    ) -> None:
        self.store, self.roots, self.opener, self.now = store, roots, opener, now
        self.slice_bytes = slice_bytes
        self.spark: SparkSession = store.spark
        self.spark.dataSource.register(H5PartDataSource)
        self.jobs: list[Job] = []
        self._made: list[str] = []

    def add(self, job: Job) -> Job:
        self.jobs.append(job)
        return job

    def run(self) -> None:
        groups: dict[tuple[str, ScanOptions], list[Job]] = defaultdict(list)
        for job in self.jobs:
            groups[job.simulation_id, job.options].append(job)
        self.jobs = []
        try:
            for (simulation_id, options), jobs in groups.items():
                names = [j.feature.name for j in jobs]
                if len(set(names)) != len(names):
                    raise ValueError(f"a feature is queued twice for {simulation_id}: {names}")
                self._run_group(simulation_id, [j.feature for j in jobs], options)
        finally:
            for path in self._made:
                drop_work(self.spark, path)
            self._made = []

    def raw(
        self,
        table: str,
        paths: Sequence[str],
        skip: bool = False,
        columns: Sequence[str] | None = None,
        steps: Mapping[str, Collection[float]] | None = None,
    ) -> DataFrame:
        """Raw rows of one table of the given files; of `columns` only, and of `steps` (times by path)."""
        reader = self.spark.read.format("h5part").option("table", table)
        if columns is not None:
            reader = reader.option("columns", "\n".join(columns))
        if steps is not None:
            lines = (f"{p}\t{','.join(map(repr, sorted(steps.get(p, ()))))}" for p in paths)
            reader = reader.option("steps", "\n".join(lines))
        if self.slice_bytes:
            reader = reader.option("slice_bytes", str(self.slice_bytes))
        if self.opener:
            reader = reader.option("opener", self.opener)
        return (
            reader.option("validate", str(skip).lower())
            .option("paths", "\n".join(paths))
            .load()
        )

    def judged(self, simulation_id: str, options: ScanOptions) -> DataFrame:
        """All files of a simulation, with the reason where one is left out."""
        from starfold.sources.files import file_catalog

        files = file_catalog(self.spark, self.roots[simulation_id])
        local = files.withColumn("path", F.regexp_replace("path", r"^file:(//)?", ""))
        return judged_files(
            describe_files(local),
            now=self.now(),
            wait_age_hour=options.wait_age_hour,
            every=options.sample_every_nb_time,
            exclude_bad=options.exclude_bad_dirname,
        )

    def catalog(self, simulation_id: str, options: ScanOptions) -> DataFrame:
        """The files to read."""
        return self.judged(simulation_id, options).where("left_out is null").drop("left_out")

    def _steps(self, simulation_id: str, catalog: DataFrame, skip: bool) -> DataFrame:
        """Steps of the listed files, from the stored index; only new and changed files are opened.

        A file that can't be read has one row with its `problem` and no steps.
        """
        listed = catalog.select(F.col("path").alias("source_hdf5_path"), "mtime")
        known = self.store.manifest(simulation_id, _STEPS)
        if skip is False:
            known = known.where("problem is null")  # a strict run tries bad files again
        new = listed.join(known.select("source_hdf5_path", "mtime"), ["source_hdf5_path", "mtime"], "left_anti")
        paths = [r[0] for r in new.select("source_hdf5_path").collect()]
        if paths:
            raw = self.raw("steps", paths, skip)
            rows = raw_steps(raw, simulation_id)
            path = self._work("steps")
            rows.write.parquet(path)
            rows = self.spark.read.parquet(path)
            # slices are checked one by one; a problem in one of them stands for the whole file
            problems = rows.groupBy("source_hdf5_path").agg(F.max("problem").alias("_problem"))
            whole = F.col("_problem").isNull() | F.col("problem").eqNullSafe(F.col("_problem"))
            rows = rows.join(problems, "source_hdf5_path").where(whole).select(*rows.columns).distinct()
            entries = new.join(problems.withColumnRenamed("_problem", "problem"), "source_hdf5_path", "left")
            self.store.commit(simulation_id, _STEPS, rows, entries)
            self.store.compact(simulation_id, _STEPS)
        return self.store.read(simulation_id, _STEPS).join(
            listed.select("source_hdf5_path"), "source_hdf5_path", "left_semi"
        )

    def _work(self, label: str) -> str:
        """Path of an intermediate table, deleted at the end of the run."""
        self._made.append(work_path(self.spark, label))
        return self._made[-1]

    def _meta(self, simulation_id: str, feature: Feature, options: ScanOptions) -> dict[str, Any]:
        """What a stored feature was made with; features that need the primordial pairs also
        depend on their content."""
        meta = feature.meta(options)
        if feature.needs_primordial and self.store.has(simulation_id, "primordial_binary"):
            pairs_now = self.store.read(simulation_id, "primordial_binary")
            mark = pairs_now.agg(
                F.count("*"), F.sum(F.xxhash64("primordial_pair_key").cast("decimal(38,0)"))
            ).first()
            meta["primordial"] = f"{mark[0]}:{mark[1]}"
        return meta

    def _run_group(
        self, simulation_id: str, features: list[Feature], options: ScanOptions
    ) -> None:
        # the catalogue is one row per file; file names are what the driver schedules by
        judged = self.judged(simulation_id, options)
        path = self._work("catalog")
        judged.write.parquet(path)
        judged = self.spark.read.parquet(path)
        catalog = judged.where("left_out is null").drop("left_out")
        left = judged.where("left_out is not null").drop("run_dir")
        if self.store.has(simulation_id, LEFT_OUT) or not left.isEmpty():
            self.store.write_table(simulation_id, LEFT_OUT, left)
        if catalog.isEmpty():
            return
        steps = self._steps(simulation_id, catalog, options.skip_unreadable_files)
        bad = steps.where("problem is not null").select("source_hdf5_path", "problem").distinct()
        winners = step_winners(steps.where("problem is null")).where(
            on_grid("ttot", options.sample_every_nb_time)
        )
        path = self._work("winners")
        winners.write.parquet(path)
        winners = self.spark.read.parquet(path)
        names = [f.name for f in features]
        first: list[Feature] = []
        if any(f.needs_primordial for f in features):
            first = [FEATURES["primordial_binary"]]
        for part in (first, [f for f in features if f not in first]):
            if part:
                self._run_features(simulation_id, part, options, catalog, winners, bad)
        if first and "primordial_binary" not in names:
            self.store.compact(simulation_id, "primordial_binary")

    def _run_features(
        self,
        simulation_id: str,
        features: list[Feature],
        options: ScanOptions,
        catalog: DataFrame,
        winners: DataFrame,
        bad: DataFrame,
    ) -> None:
        order = [r["path"] for r in catalog.orderBy("filename_time", "path").select("path").collect()]
        broken = {r["source_hdf5_path"] for r in bad.select("source_hdf5_path").collect()}
        todo: dict[str, set[str]] = {}
        gone: dict[str, DataFrame] = {}
        metas, staged = {}, {}
        for feature in features:
            metas[feature.name] = self._meta(simulation_id, feature, options)
            stored = self.store.meta(simulation_id, feature.name)
            again = options.force or (bool(stored) and stored != metas[feature.name])
            manifest = self.store.manifest(simulation_id, feature.name)
            if again:
                # the new versions are published together at the end; until then the old ones stand
                staged[feature.name] = []
                manifest = manifest.where("false")
            rows = files_to_process(
                catalog,
                manifest,
                tail_only=options.incremental_from_cache_tail,
                winners=winners,
            )
            todo[feature.name] = {r["path"] for r in rows.select("path").collect()}
            listed = catalog.select(F.col("path").alias("source_hdf5_path"))
            gone[feature.name] = manifest.where(F.size("ttot") > 0).join(listed, "source_hdf5_path", "left_anti")
        work = [p for p in order if any(p in paths for paths in todo.values())]
        size = options.checkpoint_every_files or max(1, len(work))
        for start in range(0, len(work), size):
            batch = work[start : start + size]
            readable = [p for p in batch if p not in broken]
            tables = self._tables(simulation_id, readable, features, winners)
            files = self._file_entries(catalog, batch, tables, bad)
            for feature in features:
                mine = [p for p in batch if p in todo[feature.name]]
                if mine:
                    self._build(
                        simulation_id, feature, tables, files, mine, batch,
                        metas[feature.name], staged.get(feature.name),
                    )
        for feature in features:
            by = feature.key
            if staged.get(feature.name):
                self.store.publish(simulation_id, feature.name, staged[feature.name], metas[feature.name], by)
            elif not gone[feature.name].isEmpty():
                # files that are no longer part of the simulation lose their rows
                empty = self.store.read(simulation_id, feature.name).where("false")
                left = gone[feature.name].withColumn("ttot", F.array().cast("array<double>"))
                self.store.commit(simulation_id, feature.name, empty, left, metas[feature.name], by)
            if len(self.store.pointer(simulation_id, feature.name).get("versions", [])) > COMPACT_AFTER:
                self.store.compact(simulation_id, feature.name)

    def _tables(
        self, simulation_id: str, paths: list[str], features: list[Feature], winners: DataFrame
    ) -> Tables:
        """Lake tables of a batch of files, read once and written for all features of the group.

        Of each table only the columns that some feature reads leave the files, and only the steps that the
        files stand for; the scalars are read whole, as their first step has the file's factors.
        """
        needed = {t for f in features for t in f.tables} | {"scalars"}
        columns: dict[str, set[str] | None] = {}
        for name in needed - {"scalars"}:
            asked = [f.columns.get(name) for f in features if name in f.tables]
            columns[name] = None if None in asked else {c for part in asked for c in part or ()}
        held = winners.join(self._paths(paths), "source_hdf5_path", "left_semi")
        times: dict[str, set[float]] = {p: set() for p in paths}
        for r in held.select("source_hdf5_path", "ttot").collect():
            times[r["source_hdf5_path"]].add(r["ttot"])
        raw = {n: self.raw(n, paths, columns=raw_names(f"snapshot_{n}", columns[n]), steps=times) for n in columns}
        raw["scalars"] = self.raw("scalars", paths)
        # scalars feed every other table: keep the small table instead of reopening each file
        path = self._work("raw-scalars")
        raw["scalars"].write.parquet(path)
        raw["scalars"] = self.spark.read.parquet(path)
        keep = winners.select("simulation_id", "source_hdf5_path", "ttot")
        tables: Tables = {}
        for name, rows in lake_tables(raw, simulation_id, keep, columns).items():
            target = self._work(name)
            rows.write.parquet(target)
            tables[name.removeprefix("snapshot_")] = self.spark.read.parquet(target)
        if any(f.needs_primordial for f in features):
            tables["primordial"] = self.store.read(simulation_id, "primordial_binary")
        return tables

    def _paths(self, paths: list[str]) -> DataFrame:
        return self.spark.createDataFrame([(p,) for p in paths], "source_hdf5_path string")

    def _file_entries(
        self, catalog: DataFrame, batch: list[str], tables: Tables, bad: DataFrame
    ) -> DataFrame:
        """Manifest entries of a batch: the snapshots each file stands for, or why it is unreadable."""
        known = catalog.select(F.col("path").alias("source_hdf5_path"), "mtime")
        found = tables["scalars"].groupBy("source_hdf5_path").agg(F.sort_array(F.collect_set("ttot")).alias("ttot"))
        entries = self._paths(batch).join(known, "source_hdf5_path").join(found, "source_hdf5_path", "left")
        entries = entries.join(bad, "source_hdf5_path", "left")
        return entries.withColumn("ttot", F.coalesce("ttot", F.array().cast("array<double>")))

    def _build(
        self,
        simulation_id: str,
        feature: Feature,
        tables: Tables,
        files: DataFrame,
        mine: list[str],
        batch: list[str],
        meta: dict[str, Any],
        staged: list[int] | None,
    ) -> None:
        used, done = tables, files
        if len(mine) < len(batch):
            only = self._paths(mine)
            used = {
                n: t.join(only, "source_hdf5_path", "left_semi")
                if "source_hdf5_path" in t.columns and n != "primordial"
                else t
                for n, t in tables.items()
            }
            done = files.join(only, "source_hdf5_path", "left_semi")
        rows = feature.build(used)
        if staged is not None:
            staged.append(self.store.stage(simulation_id, feature.name, rows, done))
        else:
            self.store.commit(simulation_id, feature.name, rows, done, meta, feature.key)


def raw_tables(
    builder: Builder,
    simulation_id: str | None,
    path: str,
    columns: dict[str, list[str] | None],
) -> Tables:
    """Raw tables of one file, from the lake when it holds the file and all columns.

    Otherwise the file itself is parsed. `columns` maps table names to raw columns (None: all).
    """
    from starfold.operators.lake_tables import can_serve, raw_from_lake

    store = builder.store
    if simulation_id is not None and all(
        can_serve(f"snapshot_{t}", c) and store.has(simulation_id, f"snapshot_{t}")
        for t, c in columns.items()
    ):
        here = F.col("source_hdf5_path") == path
        scalars = store.read(simulation_id, "snapshot_scalars").where(here)
        if not scalars.isEmpty():
            return {
                t: raw_from_lake(
                    f"snapshot_{t}", store.read(simulation_id, f"snapshot_{t}").where(here),
                    scalars, c,
                )
                for t, c in columns.items()
            }
    out = {}
    for table, wanted in columns.items():
        known = [] if table == "scalars" else raw_columns(table)
        names = None if wanted is None or not known else [n for n in dict.fromkeys(wanted) if n in known]
        rows = builder.raw(table, [path], columns=names)
        if wanted is not None:
            names = [n for n in dict.fromkeys(wanted) if n != "TTOT" and n in rows.columns]
            rows = rows.select(*[F.col(f"`{n}`") for n in names], "TTOT")
        out[table] = rows
    return out
