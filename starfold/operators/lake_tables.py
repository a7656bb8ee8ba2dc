"""Raw snapshot tables to registered lake tables, and back."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, functions as F

from starfold import constants as K
from starfold.functions.numeric import norm3, round_id
from starfold.operators.dedup import step_winners
from starfold.schema.registry import SORT_KEYS, TABLES, TYPES, table_schema

_FILE_STEP = ["simulation_id", "source_hdf5_path", "ttot"]
_OFFSETS = [f"_rdens_{a}" for a in "xyz"]


def step_context(raw_scalars: DataFrame) -> DataFrame:
    """Per (file, ttot): time scale and density centre in pc, with the file's first-row factors.

    Scale factors are constants of a run and taken from the first snapshot of the file.
    """
    first = raw_scalars.groupBy("source_hdf5_path").agg(
        *[
            F.min_by(f"`{n}`", "source_row_index").alias(alias)
            for n, alias in (("RBAR", "_rbar"), ("TSCALE", "_tscale"))
        ]
    )
    return raw_scalars.join(first, "source_hdf5_path").select(
        "source_hdf5_path",
        "TTOT",
        "_tscale",
        *[
            (F.col(f"`RDENS({i})`") * F.col("_rbar")).alias(o)
            for i, o in enumerate(_OFFSETS, start=1)
        ],
    )


def _converted(dtype: str, value: Column) -> Column:
    if dtype == "int64":
        return round_id(value)
    if dtype == "int32":
        return round_id(value).cast("int")
    return value.cast(TYPES[dtype])


def _scalars(raw: DataFrame, simulation_id: str) -> DataFrame:
    columns = [
        _converted(c.dtype, F.col(f"`{c.raw}`")).alias(c.name)
        for c in TABLES["snapshot_scalars"][1]
        if c.raw
    ]
    return raw.select(
        F.lit(simulation_id).alias("simulation_id"),
        F.col("TTOT").alias("ttot"),
        (F.col("TTOT") * F.col("TSCALE")).alias("time_myr"),
        *columns,
        "source_hdf5_path",
    )


# Columns that every lake table carries, whichever others are asked for.
_FIXED = ("simulation_id", "ttot", "time_myr", "source_hdf5_path")


def kept_columns(table: str, only: Collection[str] | None) -> list[str] | None:
    """The lake columns to make for `only` (None: all): those, the fixed ones and what they are made of."""
    if only is None:
        return None
    names = table_schema(table).names
    unknown = [n for n in only if n not in names]
    if unknown:
        raise ValueError(f"{table} has no columns {unknown}")
    axes = [c.name for c in TABLES[table][1] if c.centred] if "r_pc" in only else []
    return [n for n in names if n in only or n in _FIXED or n in axes]


def raw_names(table: str, only: Collection[str] | None) -> list[str] | None:
    """The raw columns that those lake columns are read from."""
    kept = kept_columns(table, only)
    return None if kept is None else [c.raw for c in TABLES[table][1] if c.raw and c.name in kept]


def _objects(
    table: str, raw: DataFrame, context: DataFrame, simulation_id: str, only: Collection[str] | None = None
) -> DataFrame:
    """Typed columns; positions are centred in double precision and stored in single."""
    spec = [c for c in TABLES[table][1] if only is None or c.name in only]
    joined = raw.join(context, ["source_hdf5_path", "TTOT"])

    def column(c) -> Column:
        value = F.col(f"`{c.raw}`")
        if c.name == "bin_label":
            return F.coalesce(_converted(c.dtype, value), F.lit(K.BIN_LABEL_UNKNOWN))
        if c.centred:
            value = value.cast("double") - F.col(_OFFSETS[c.centred - 1])
        return _converted(c.dtype, value)

    out = joined.select(
        F.lit(simulation_id).alias("simulation_id"),
        F.col("TTOT").alias("ttot"),
        (F.col("TTOT") * F.col("_tscale")).alias("time_myr"),
        *[column(c).alias(c.name) for c in spec if c.raw],
        "source_hdf5_path",
    )
    if any(c.name == "r_pc" for c in spec):
        axes = [F.col(c.name).cast("double") for c in spec if c.centred]
        out = out.withColumn("r_pc", norm3(*axes).cast("float"))
    return out


def raw_steps(raw: DataFrame, simulation_id: str) -> DataFrame:
    """(simulation, ttot, mtime, file) of every step of a raw scalars or steps frame; a steps
    frame also says which files can't be read."""
    more = ["problem"] if "problem" in raw.columns else []
    return raw.select(
        F.lit(simulation_id).alias("simulation_id"),
        F.col("TTOT").alias("ttot"),
        F.col("source_mtime").alias("mtime"),
        "source_hdf5_path",
        *more,
    )


def lake_tables(
    raw: dict[str, DataFrame],
    simulation_id: str,
    winners: DataFrame | None = None,
    columns: dict[str, Collection[str] | None] | None = None,
) -> dict[str, DataFrame]:
    """The four lake tables of raw scalars / singles / binaries / mergers frames.

    Snapshots written by several files are taken from the latest file in every table. `winners`
    names the (simulation_id, source_hdf5_path, ttot) to keep when the frames hold only part of the
    files. `columns` names the lake columns to make of a table (singles, binaries, mergers), all where it
    has no entry.
    """
    if winners is None:
        winners = step_winners(raw_steps(raw["scalars"], simulation_id))
    keep = winners.select(*_FILE_STEP)
    context = step_context(raw["scalars"])
    out = {"snapshot_scalars": _scalars(raw["scalars"], simulation_id)}
    made: dict[str, list[str] | None] = {}
    for name in ("singles", "binaries", "mergers"):
        if name in raw:
            table = f"snapshot_{name}"
            made[table] = kept_columns(table, (columns or {}).get(name))
            out[table] = _objects(table, raw[name], context, simulation_id, made[table])
    return {
        table: table_schema(table).conform(rows.join(keep, _FILE_STEP, "left_semi"), made.get(table))
        for table, rows in out.items()
    }


def raw_from_lake(
    table: str, lake: DataFrame, lake_scalars: DataFrame, columns: list[str] | None = None
) -> DataFrame:
    """Raw columns of a lake table: renamed, positions moved back by the density centre.

    Requested columns keep their order, TTOT comes last.
    """
    spec = {c.raw: c for c in TABLES[table][1] if c.raw}
    wanted = [n for n in dict.fromkeys(columns or list(spec)) if n != "TTOT"]
    unknown = [n for n in wanted if n not in spec]
    if unknown:
        raise ValueError(f"{table} does not hold {unknown}")
    if table != "snapshot_scalars" and any(spec[n].centred for n in wanted):
        keys = ["simulation_id", "ttot"]
        centre = lake_scalars.select(
            *keys,
            *[
                (F.col(f"rdens_{a}_nb") * F.col("rbar_pc")).alias(o)
                for a, o in zip("xyz", _OFFSETS)
            ],
        )
        lake = lake.join(centre, keys, "left")

    def column(name: str) -> Column:
        c = spec[name]
        if c.centred:
            return F.col(c.name).cast("double") + F.col(_OFFSETS[c.centred - 1])
        return F.col(c.name)

    return lake.select(*[column(n).alias(n) for n in wanted], F.col("ttot").alias("TTOT"))


def can_serve(table: str, columns: list[str] | None) -> bool:
    """Can the lake answer a raw request? All requested columns or none."""
    held = {c.raw for c in TABLES[table][1] if c.raw} | {"TTOT"}
    return columns is None or set(columns) <= held


def conservation(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per snapshot in each lake table next to the counts its scalars promise."""
    keys = ["simulation_id", "ttot"]
    out = tables["snapshot_scalars"].select(*keys, "n_single", "n_binary", "n_merger")
    for name in ("singles", "binaries", "mergers"):
        if f"snapshot_{name}" in tables:
            counted = tables[f"snapshot_{name}"].groupBy(*keys).agg(
                F.count(F.lit(1)).alias(f"rows_{name}")
            )
            out = out.join(counted, keys, "left").fillna(0, [f"rows_{name}"])
    return out


def sorted_for_write(table: str, rows: DataFrame) -> DataFrame:
    """Rows clustered inside each output file, for row-group pruning on (ttot, id)."""
    return rows.sortWithinPartitions(*SORT_KEYS[table])
