"""Command line: build features, backfill labels, check files before a build."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import functions as F

from starfold.config import load_config
from starfold.plans.build import FEATURES, Builder, Job, ScanOptions, expand_features
from starfold.plans.maintain import backfill_store, nzero_of, validate_backfill
from starfold.plans.store import FeatureStore
from starfold.schema.registry import LAKE_TABLES
from starfold.session import get_spark


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="starfold", description=__doc__)
    parser.add_argument("--config", help="YAML or JSON settings file")
    parser.add_argument("--master", help="Spark master, if not set by spark-submit")
    commands = parser.add_subparsers(dest="command", required=True)

    analyze = commands.add_parser("analyze", help="build or update feature tables")
    analyze.add_argument("--simu", action="append", help="simulation (repeatable; default all)")
    analyze.add_argument(
        "--features", default="pilot", help="comma separated names, or the groups pilot and lake"
    )
    analyze.add_argument("--force", action="store_true", help="rebuild from scratch")
    analyze.add_argument("--opener", help="module:function that opens a snapshot file")

    fill = commands.add_parser("backfill-bin-label", help="derive unknown binary labels")
    fill.add_argument("--simu", action="append")
    fill.add_argument("--dry-run", action="store_true")
    fill.add_argument("--validate", action="store_true")
    fill.add_argument("--nzero", action="append", default=[], metavar="SIMU=N")

    check = commands.add_parser("preflight", help="gaps and overlaps of the snapshot files")
    check.add_argument("--simu", action="append")
    check.add_argument("--opener")
    return parser


def parse_nzero(pairs: Sequence[str]) -> dict[str, int]:
    out = {}
    for pair in pairs:
        name, sep, number = pair.partition("=")
        if not sep or not number.strip().isdigit():
            raise ValueError(f"--nzero wants SIMU=N, got {pair!r}")
        out[name] = int(number)
    return out


def main(argv: Sequence[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    config = load_config(args.config)
    simulations = args.simu or list(config.simulations)
    unknown = [s for s in simulations if s not in config.simulations]
    if unknown or not simulations:
        raise SystemExit(f"no such simulation in paths.simulations: {unknown or 'none set'}")
    spark = get_spark(args.master)
    store = FeatureStore(spark, config.cache_root, config.lake_root, tuple(config.simulations))

    if args.command == "analyze":
        builder = Builder(store, config.simulations, opener=args.opener)
        for simulation in simulations:
            for name in expand_features(args.features.split(",")):
                options = ScanOptions(
                    **config.scan_options(lake=name in LAKE_TABLES, force=args.force)
                )
                builder.add(Job(simulation, FEATURES[name], options))
        builder.run()
    elif args.command == "backfill-bin-label":
        given = parse_nzero(args.nzero)
        for simulation in simulations:
            nzero = given.get(simulation) or nzero_of(store, simulation)
            if args.validate:
                print(simulation, validate_backfill(store, simulation, nzero))
            else:
                backfill_store(store, simulation, nzero, dry_run=args.dry_run).show(truncate=False)
    else:
        from starfold.sources import files as fl

        builder = Builder(store, config.simulations, opener=args.opener)
        for simulation in simulations:
            catalog = builder.catalog(simulation, ScanOptions(sample_every_nb_time=None))
            print(simulation)
            fl.directory_overlaps(catalog).show(truncate=False)
            fl.duplicate_times(catalog).show(truncate=False)
            named = catalog.withColumn("simulation_id", F.lit(simulation))
            fl.spacing_gaps(named, ["simulation_id"]).show(truncate=False)
            paths = [r["path"] for r in catalog.select("path").collect()]
            steps = builder.raw("steps", paths).selectExpr(
                f"'{simulation}' AS simulation_id",
                "source_hdf5_path",
                "source_size AS size_bytes",
                "N_STAR AS n_star",
                "TTOT AS ttot",
            )
            fl.preflight_totals(steps).show(truncate=False)
    return 0
