"""Spark data source for snapshot HDF5 files.

    spark.dataSource.register(H5PartDataSource)
    spark.read.format("h5part").option("table", "singles").load("/data/sim/**/*.h5part")

A file is cut into slices by its size, one input partition each: a run of `Step#` groups, or a range of rows of one
group, so a large file is read by many tasks. Each slice becomes Arrow batches; only the requested datasets leave
the file and nothing passes through the driver. Equality, IN and range filters on TTOT and on the file's path
are taken over from Spark: other files get no partition, other steps are passed over before their datasets are read.
"""

from __future__ import annotations

import glob
import importlib
import operator
import os
import re
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

from starfold.schema.registry import SCALAR_NAMES, TABLES

# Datasets are called "<number> <name>"; the number says which table a dataset belongs to.
NUMBER_RANGES = {"singles": (1, 100), "binaries": (101, 200), "mergers": (201, 300)}
# Slot 176 holds the pair label under this other name in some old files.
LABEL_ALIAS = "176 Bin cm Name"
_DATASET = re.compile(r"^(\d{3}) (.+)$")
_TIME = re.compile(r"snap\.40_([0-9.eE+-]+?)\.h5part$")
_BATCH_ROWS = 100_000
# Bytes of a file that one input partition reads, unless the option slice_bytes says otherwise.
SLICE_BYTES = 256 << 20
_TESTS = {
    EqualTo: operator.eq,
    In: lambda value, listed: value in listed,
    GreaterThan: operator.gt,
    GreaterThanOrEqual: operator.ge,
    LessThan: operator.lt,
    LessThanOrEqual: operator.le,
}


def raw_columns(table: str) -> list[str]:
    """Raw columns the registered lake table is built from."""
    return [c.raw for c in TABLES[f"snapshot_{table}"][1] if c.raw]


def _hdf5_opener(path: str) -> Any:
    import h5py  # only needed where real files are read

    return h5py.File(path, "r")


def _opener(spec: str | None) -> Any:
    """`module:function` that opens a file, for tests and other containers."""
    if not spec:
        return _hdf5_opener
    module, function = spec.split(":")
    return getattr(importlib.import_module(module), function)


def datasets_of(group: Any, table: str) -> dict[str, str]:
    """Logical name -> dataset key of one table in a step group."""
    low, high = NUMBER_RANGES[table]
    found: dict[str, str] = {}
    for key in sorted(group.keys()):
        hit = _DATASET.match(key)
        if hit and low <= int(hit.group(1)) <= high and key != LABEL_ALIAS:
            found.setdefault(hit.group(2), key)
    if table == "binaries" and LABEL_ALIAS in group.keys():
        found.setdefault("Bin Label", LABEL_ALIAS)
    return found


def rows_of(group: Any, names: dict[str, str]) -> int:
    """Rows of one table in a step, all its datasets being equally long."""
    lengths = {len(group[key]) for key in names.values()}
    if len(lengths) > 1:
        raise ValueError(f"datasets differ in length: {sorted(lengths)}")
    return lengths.pop() if lengths else 0


class Slice(InputPartition):
    """Part `part` of `parts` of a file; every step counts the same and is cut by rows where parts meet in it."""

    def __init__(self, path: str, part: int = 0, parts: int = 1) -> None:
        super().__init__((path, part, parts))
        self.path, self.part, self.parts = path, part, parts

    def share(self, index: int, steps: int) -> tuple[int, int]:
        """From and to which fraction (in 1 / parts) of step number `index` this slice reads."""
        lo, hi = self.part * steps - index * self.parts, (self.part + 1) * steps - index * self.parts
        return max(lo, 0), min(hi, self.parts)


def step_keys(handle: Any) -> list[str]:
    return sorted(k for k in handle.keys() if k.startswith("Step#"))


def _problem(opener: Any, piece: Slice) -> str | None:
    """Why this slice of a file can't be read, or None. Its part of every dataset is read once.

    A file counts as a whole: one bad slice makes all of it unreadable, so that no table takes
    part of a file whose rest another table misses.
    """
    try:
        with opener(piece.path) as handle:
            keys = step_keys(handle)
            for index, key in enumerate(keys):
                lo, hi = piece.share(index, len(keys))
                if lo >= hi:
                    continue
                group = handle[key]
                float(np.asarray(group["000 Scalars"])[0])
                for table in NUMBER_RANGES:
                    names = datasets_of(group, table)
                    n = rows_of(group, names)
                    for name in names.values():
                        np.asarray(group[name][n * lo // piece.parts : n * hi // piece.parts])
    except Exception as error:  # containers raise what they like on broken files
        return f"{type(error).__name__}: {error}"
    return None


class H5PartReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.schema, self.options = schema, options
        self.table = options.get("table", "singles")
        self.tests: list[tuple[str, type, Any]] = []
        self.wanted: dict[str, set[float]] = {}
        for line in (options.get("steps") or "").split("\n"):
            if line:
                path, _, times = line.rpartition("\t")
                self.wanted[path] = {float(t) for t in times.split(",") if t}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take over the filters on TTOT and the path; a step without a time exists only among the steps."""
        mine = {"source_hdf5_path"} if self.table == "steps" else {"source_hdf5_path", "TTOT"}
        for f in filters:
            name = getattr(f, "attribute", ())
            if type(f) in _TESTS and len(name) == 1 and name[0] in mine and f.value is not None:
                self.tests.append((name[0], type(f), f.value))
            else:
                yield f

    def _passes(self, column: str, value: Any) -> bool:
        return all(_TESTS[kind](value, asked) for name, kind, asked in self.tests if name == column)

    def partitions(self) -> list[Slice]:
        """Slices of the files. `paths` are taken as they are; only `path` may be a folder or a pattern."""
        found = set((self.options.get("paths") or "").split("\n")) - {""}
        pattern = self.options.get("path")
        if pattern:
            if os.path.isdir(pattern):
                pattern = os.path.join(glob.escape(pattern), "**", "*.h5part")
            found |= {pattern} if os.path.exists(pattern) else set(glob.glob(pattern, recursive=True))
        size = int(self.options.get("slice_bytes", SLICE_BYTES))
        small = self.table == "scalars" or (self.table == "steps" and not self._validates())
        out = []
        for path in sorted(found):
            times = self.wanted.get(path)
            if not self._passes("source_hdf5_path", path):
                continue
            if times is not None and not any(self._passes("TTOT", t) for t in times):
                continue
            whole = os.path.getsize(path) if os.path.exists(path) else 0
            parts = 1 if small else max(1, -(-whole // size))
            out += [Slice(path, i, parts) for i in range(parts)]
        return out

    def _validates(self) -> bool:
        return self.options.get("validate", "false").lower() == "true"

    def read(self, partition: Slice | None) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition is None:  # Spark's only partition where there are none
            return
        schema = to_arrow_schema(self.schema)
        path = partition.path
        hit = _TIME.search(path)
        constants = {
            "source_hdf5_path": path,
            "source_mtime": os.path.getmtime(path),
            "source_size": os.path.getsize(path),
            "source_file_time": float(hit.group(1)) if hit else None,
        }
        opener = _opener(self.options.get("opener"))
        if self._validates():
            problem = _problem(opener, partition)
            if problem:
                if self.table == "steps":
                    yield from self._batches(schema, 0, 1, {}, {**constants, "problem": problem})
                return
        with opener(path) as handle:
            yield from self._steps(handle, schema, constants, partition)

    def _steps(self, handle: Any, schema: pa.Schema, constants: dict, piece: Slice) -> Iterator:
        seen: set[float] = set()
        wanted = self.wanted.get(piece.path)
        keys = step_keys(handle)
        # string order of the step keys decides which of two equal times is kept
        for index, key in enumerate(keys):
            lo, hi = piece.share(index, len(keys))
            if hi <= 0:
                break
            group = handle[key]
            if self.table == "steps":
                if lo == 0 and ("000 Scalars" in group.keys() or "Time" in group.attrs):
                    inside = "000 Scalars" in group.keys()
                    row = {
                        "TTOT": float(np.asarray(group["000 Scalars"])[0] if inside else group.attrs["Time"]),
                        "N_STAR": int(group.attrs.get("N_STAR", 0)),
                    }
                    yield from self._batches(schema, 0, 1, row, {**constants, "step_key": key})
                continue
            slots = np.asarray(group["000 Scalars"])
            ttot = float(slots[0])
            if ttot in seen:
                continue
            seen.add(ttot)
            if lo >= hi or not self._passes("TTOT", ttot) or (wanted is not None and ttot not in wanted):
                continue
            extra = {**constants, "step_key": key, "source_row_index": index, "TTOT": ttot}
            if self.table == "scalars":
                values = dict(zip(SCALAR_NAMES, (float(v) for v in slots)))
                yield from self._batches(schema, 0, 1, values, extra)
                continue
            names = datasets_of(group, self.table)
            data = {f.name: group[names[f.name]] for f in schema if f.name in names}
            rows = rows_of(group, {k: names[k] for k in data} or names)
            yield from self._batches(schema, rows * lo // piece.parts, rows * hi // piece.parts, data, extra)

    def _batches(self, schema: pa.Schema, first: int, stop: int, data: dict, extra: dict) -> Iterator:
        """Rows first..stop of the datasets; each batch reads its own range."""
        for start in range(first, stop, _BATCH_ROWS):
            n = min(_BATCH_ROWS, stop - start)
            arrays = []
            for field in schema:
                if field.name in extra:
                    arrays.append(pa.array([extra[field.name]] * n, field.type))
                elif field.name in data:
                    value = data[field.name]
                    part = np.asarray(value[start : start + n]) if hasattr(value, "__getitem__") else [value]
                    arrays.append(pa.array(part).cast(field.type, safe=False))
                else:
                    arrays.append(pa.nulls(n, field.type))
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)


class H5PartDataSource(DataSource):
    """Options: table (scalars, singles, binaries, mergers, steps), columns (newline-separated raw
    names; default: those of the lake table), steps (lines of path, tab, comma-separated times: of these files
    only these steps), slice_bytes, validate (leave out slices that can't be read; the steps table has a row
    with the `problem` instead), opener."""

    @classmethod
    def name(cls) -> str:
        return "h5part"

    def schema(self) -> str:
        table = self.options.get("table", "singles")
        fields: list[str] = []
        if table == "steps":
            fields += ["`N_STAR` bigint", "`problem` string"]
        elif table == "scalars":
            fields += [f"`{n}` double" for n in SCALAR_NAMES[1:]]
        else:
            wanted = self.options.get("columns")
            names = raw_columns(table) if wanted is None else [n for n in wanted.split("\n") if n]
            types = {
                c.raw: "double" if c.dtype.startswith("int") else "float"
                for c in TABLES[f"snapshot_{table}"][1]
            }
            fields += [f"`{n}` {types.get(n, 'double')}" for n in names if n != "TTOT"]
        fields += [
            "`TTOT` double",
            "`step_key` string",
            "`source_row_index` bigint",
            "`source_hdf5_path` string",
            "`source_mtime` double",
            "`source_size` bigint",
            "`source_file_time` double",
        ]
        return ", ".join(fields)

    def reader(self, schema: StructType) -> H5PartReader:
        return H5PartReader(schema, dict(self.options))
