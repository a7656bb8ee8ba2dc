"""Dedup of long repeated byte strings by suffix classes (longest-previous-factor at a threshold).

Every position of every text starts a suffix. In suffix order, the suffixes that share their first
`LENGTH` bytes stand together, and the previous and next smaller positions of that run say whether
a position has an earlier or a later match of `LENGTH` bytes. For removal only the threshold
matters, so the runs are formed as classes of equal `LENGTH`-byte prefixes, and a class's first
position stands for the previous smaller ones: a position has a longest previous factor of at least
`LENGTH` exactly when it is not the first of its class. `keep_first=True` removes the bytes of
later copies, `keep_first=False` those of all copies.

A whole suffix order of a corpus can't be shuffled (each suffix would travel with `LENGTH` bytes),
so classes are found in three steps of rising detail.

1. Anchors. Of the `CORE`-byte substrings inside a window of `LENGTH` bytes the one with the least
   hash is the window's anchor; equal windows have equal anchors at the same place. Consecutive
   windows with one anchor form a run, about one per 128 positions. Only anchors whose core
   hash occurs twice or more go on.
2. Runs. Two runs with equal text (core hash and hash of all bytes of the run) have equal
   windows throughout: the whole run is repeated. That settles the inside of copied passages.
3. Edges. Runs of one core that differ as wholes, mostly at the ends of copied passages, are
   compared window by window: their bytes are fetched once (one row per different run), sorted by core and
   compared inside tasks. A core with more than `HOT` different runs is not put into one
   task: its windows become rows and are counted by a partial aggregate.

Cores, runs and windows are compared by two independent 64-bit hashes together.

Defined cases. Null text counts as empty. Texts shorter than `LENGTH` bytes lose nothing. Repeated
rows are separate documents, so their common strings count as repeated. Null ids come first in the order
of positions. Very long texts are read in segments; nothing is cut off. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import pa_schema
from starfold.llm.shingles import mix
from starfold.session import materialize

LENGTH = 400
CORE = 144
HOT = 4000
SEGMENT = 1 << 20
PLACE_BITS = np.uint64(24)
PLACE = np.uint64((1 << 24) - 1)

RUNS = "doc long, th long, p long, lo long, hi long, h long, s long"
EDGES = "h long, n long, doc long, th long, p long, lo long, ctx binary"
SPANS = "doc long, th long, a long, b long, later boolean"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


class Rolling:
    """Polynomial hashes of substrings modulo 2^64."""

    def __init__(self, base: int) -> None:
        self.base = base | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def sums(self, raw: np.ndarray) -> np.ndarray:
        n = len(raw) + 1
        if len(self.up) < n:
            size = max(n, min(2 * n, SEGMENT + 4 * LENGTH))
            self.up = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, self.base, dtype=np.uint64)])
            self.down = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, self.inverse, dtype=np.uint64)])
        out = np.zeros(n, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[: n - 1], out=out[1:])
        return out

    def of(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values."""
    n = len(values)
    full = -(-n // width) * width
    padded = np.full(full, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def window_runs(raw: np.ndarray, one: Rolling, two: Rolling, length: int, core: int) -> Iterator[tuple]:
    """(p, lo, hi, h, s) arrays: windows lo..hi share the anchor p."""
    for at in range(0, max(len(raw) - length + 1, 0), SEGMENT):
        part = raw[at : at + SEGMENT + length - 1]
        sums = one.sums(part)
        n = len(part) - core + 1
        places = np.arange(n, dtype=np.int64)
        cores = one.of(sums, places, places + core)
        keyed = (cores & ~PLACE) | places.astype(np.uint64)
        least = sliding_min(keyed, length - core + 1)
        anchor = (least & PLACE).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        last = np.r_[first[1:] - 1, len(anchor) - 1]
        p = anchor[first]
        s = two.of(two.sums(part), first, last + length)
        yield p + at, first + at, last + at, cores[p].view(np.int64), s.view(np.int64)


def anchors(docs: DataFrame, id_col: str, text_col: str, length: int, core: int) -> DataFrame:
    target = pa_schema(docs.sparkSession, RUNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = Rolling(0x9E3779B97F4A7C15), Rolling(0xD1B54A32D192ED03)
        for batch in batches:
            ids, keys, cols = [], [], []
            for doc, th, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = np.frombuffer(text.encode(), dtype=np.uint8)
                for part in window_runs(raw, one, two, length, core):
                    ids += [doc] * len(part[0])
                    keys.append(np.full(len(part[0]), th, dtype=np.int64))
                    cols.append(part)
            if cols:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, type=pa.int64()),
                        pa.array(np.concatenate(keys)),
                        *(pa.array(np.concatenate(c)) for c in zip(*cols, strict=True)),
                    ],
                    schema=target,
                )

    rows = keyed_rows(docs, id_col, text_col).where(F.octet_length("text") >= length)
    return rows.mapInArrow(run, RUNS)


def keyed_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("th"), text.alias("text"))


def _edge_bytes(rows: DataFrame, docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """The bytes of the runs in `rows` (h, n, doc, th, p, lo, hi)."""
    target = pa_schema(docs.sparkSession, EDGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in target]
            for doc, th, text, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode()
                for r in runs:
                    row = (r["h"], r["n"], doc, th, r["p"], r["lo"], raw[r["lo"] : r["hi"] + length])
                    for col, v in zip(out, row, strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(out, target, strict=True)], schema=target
            )

    wanted = rows.groupBy(F.col("doc").alias("d2"), F.col("th").alias("th2")).agg(
        F.collect_set(F.struct("h", "n", "p", "lo", "hi")).alias("runs")
    )
    # Of several equal rows (same id, same text) one is enough: equal runs are one class.
    joined = keyed_rows(docs, id_col, text_col).join(
        wanted, F.col("doc").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("th2"))
    )
    return joined.select("doc", "th", "text", "runs").mapInArrow(run, EDGES)


def _windows(batch: pa.RecordBatch, two: Rolling, length: int) -> tuple[np.ndarray, ...]:
    """(row, x, w) of every window of the rows: offset to the anchor and hash."""
    p = batch.column("p").to_numpy()
    lo = batch.column("lo").to_numpy()
    rows, xs, ws = [], [], []
    for i, ctx in enumerate(batch.column("ctx").to_pylist()):
        raw = np.frombuffer(ctx, dtype=np.uint8)
        starts = np.arange(len(raw) - length + 1)
        rows.append(np.full(len(starts), i))
        xs.append(p[i] - lo[i] - starts)
        ws.append(two.of(two.sums(raw), starts, starts + length))
    return np.concatenate(rows), np.concatenate(xs), np.concatenate(ws)


def _cold_spans(edges: DataFrame, length: int) -> DataFrame:
    """Repeated windows among the runs of each core; `edges` sorted by core within partitions."""
    target = pa_schema(edges.sparkSession, SPANS)

    def solve(batch: pa.RecordBatch, two: Rolling) -> pa.RecordBatch:
        row, x, w = _windows(batch, two, length)
        h = batch.column("h").to_numpy()[row]
        docs = batch.column("doc").to_pylist()
        lo = batch.column("lo").to_numpy()
        order_of = {k: r for r, k in enumerate(sorted(set(zip((-1 if d is None else d for d in docs), lo.tolist(), strict=True))))}
        rank = np.array([order_of[(-1 if d is None else d, int(a))] for d, a in zip(docs, lo, strict=True)])[row]
        # Suffix classes: sorted by core, offset and window, positions ascending inside a class.
        order = np.lexsort((rank, w, x, h))
        same = np.r_[False, (np.diff(h[order]) == 0) & (np.diff(x[order]) == 0) & (w[order][1:] == w[order][:-1])]
        repeated = same | np.r_[same[1:], False]
        hit, later = order[repeated], same[repeated]
        start = batch.column("p").to_numpy()[row[hit]] - x[hit]
        n = batch.column("n").to_numpy()[row[hit]]
        use = (n == 1) | later  # inside a repeated run only the first copy is still open
        by = np.lexsort((start[use], later[use], row[hit][use]))
        r, a, late = row[hit][use][by], start[use][by], later[use][by]
        new = np.r_[True, (np.diff(r) != 0) | (np.diff(a) != 1) | (late[1:] != late[:-1])][: len(r)]
        first = np.flatnonzero(new)
        last = np.r_[first[1:] - 1, len(r) - 1][: len(first)]
        take = pa.array(r[first])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc").take(take), batch.column("th").take(take), pa.array(a[first]), pa.array(a[last]), pa.array(late[first])],
            schema=target,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = Rolling(0xD1B54A32D192ED03)
        held: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            h = held.column("h").to_numpy()
            cut = int(np.flatnonzero(np.r_[True, h[1:] != h[:-1]])[-1])  # the last core may go on
            if cut:
                yield solve(held.slice(0, cut).combine_chunks().to_batches()[0], two)
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield solve(held.combine_chunks().to_batches()[0], two)

    return edges.repartition("h").sortWithinPartitions("h").mapInArrow(run, SPANS)


def _hot_spans(edges: DataFrame, length: int) -> DataFrame:
    """The same for cores with very many different runs, by counting window rows."""
    schema = "h long, x long, w long, n long, doc long, th long, a long"
    target = pa_schema(edges.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = Rolling(0xD1B54A32D192ED03)
        for batch in batches:
            row, x, w = _windows(batch, two, length)
            take = pa.array(row)
            start = batch.column("p").to_numpy()[row] - x
            cols = [batch.column(c).take(take) for c in ("h", "n", "doc", "th")]
            yield pa.RecordBatch.from_arrays(
                [cols[0], pa.array(x), pa.array(w.view(np.int64)), cols[1], cols[2], cols[3], pa.array(start)], schema=target
            )

    windows = materialize(edges.mapInArrow(run, schema), "suffix-hot-windows")
    classes = windows.groupBy("h", "x", "w").agg(F.count("*").alias("k"), F.min(F.struct("doc", "a", "th")).alias("head"))
    hit = windows.join(classes.where("k > 1"), ["h", "x", "w"])
    later = F.col("head") != F.struct("doc", "a", "th")
    return hit.select("doc", "th", "a", F.col("a").alias("b"), later.alias("later"), "n").where("n = 1 or later").drop("n")


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, core: int = CORE
) -> DataFrame:
    """(doc, th, a, b, later): windows that start at a..b are repeated; `later`: an earlier copy
    exists. The spans of a document may overlap."""
    runs = materialize(anchors(docs, id_col, text_col, length, core), "suffix-runs")
    # Written, so that the joins below have two plain shuffles, which Spark can split at hot cores.
    twice = materialize(runs.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h"), "suffix-twice")
    runs = materialize(runs.join(twice, "h", "left_semi"), "suffix-candidates")
    position = F.struct("doc", "lo", "th", "p", "hi")
    classes = materialize(runs.groupBy("h", "s").agg(F.count("*").alias("n"), F.min(position).alias("head")), "suffix-classes")
    whole = runs.join(classes.where("n > 1"), ["h", "s"]).select(
        "doc", "th", F.col("lo").alias("a"), F.col("hi").alias("b"), (F.col("head") != position).alias("later")
    )
    several = materialize(classes.groupBy("h").agg(F.count("*").alias("k")).where("k > 1"), "suffix-several")
    edges = materialize(
        _edge_bytes(
            classes.join(several.select("h"), "h", "left_semi").select("h", "n", "head.*"), docs, id_col, text_col, length
        ),
        "suffix-edges",
    )
    hot = materialize(several.where(F.col("k") > HOT).select("h"), "suffix-hot")
    cold_spans = _cold_spans(edges.join(hot, "h", "left_anti"), length)
    hot_spans = _hot_spans(edges.join(hot, "h", "left_semi"), length)
    return whole.unionByName(cold_spans).unionByName(hot_spans)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    core: int = CORE,
    keep_first: bool = True,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document row."""
    spans = repeated_spans(docs, id_col, text_col, length, core)
    if keep_first:
        spans = spans.where("later")
    per_doc = spans.groupBy(F.col("doc").alias("d2"), F.col("th").alias("th2")).agg(
        F.collect_set(F.struct("a", "b")).alias("spans")
    )
    rows = keyed_rows(docs, id_col, text_col).join(
        per_doc, F.col("doc").eqNullSafe(F.col("d2")) & (F.col("th") == F.col("th2")), "left"
    )
    target = pa_schema(docs.sparkSession, RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in target]
            for doc, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw, kept, removed, n, end = text.encode(), hashlib.sha256(), 0, 0, 0
                at = 0
                for a, b in sorted((s["a"], s["b"] + length) for s in found or ()):
                    if a > end or not n:
                        kept.update(raw[at:a])
                        n += 1
                        removed += b - a
                        at = end = b
                    elif b > end:
                        removed += b - end
                        at = end = b
                kept.update(raw[at:])
                for col, v in zip(out, (doc, len(raw), removed, n, kept.hexdigest()), strict=True):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(out, target, strict=True)], schema=target
            )

    return rows.select("doc", "text", "spans").mapInArrow(run, RESULT)
