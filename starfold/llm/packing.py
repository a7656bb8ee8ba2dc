"""Best-fit packing of tokenised documents into training sequences.

A document is its token ids plus an end id; a document longer than a sequence is cut into pieces
of full length and one rest. Pieces are packed into as few sequences as possible.

Method (linear grouping). Pieces of one length are interchangeable, so the whole packing problem
is a histogram of at most `capacity` lengths, whatever the number of documents.

1. Large lengths are sorted and cut into groups of equal cardinality; every length is rounded up
   to the largest of its group. That leaves few sizes.
2. The configurations of the few sizes (which multisets fit into one sequence) are optimised by
   column generation: a linear program over the sizes, new configurations found by a knapsack.
   Whole multiples of the solution are opened; the remainder is packed best-fit.
3. The rounded sizes are replaced by the actual lengths of the group, longest first.
4. Small pieces, and what is left of the large ones, go best-fit into the room that remains,
   longest first, whole runs of equal lengths at a time.

Rounding up costs room that small pieces must fill, so the border between large and small decides
how full the sequences get: the plan is made for each of `SMALL_SHARES` and the one with the
fewest sequences is used.

The plan is a table of runs (length, first number, last number, first sequence, offset). Its size
depends on `capacity`, not on the data, so it is sent to the tasks, which look up every piece by
its length and its number among the pieces of that length. Numbers are given inside the tasks
and shifted by per-task counts; no task or window ever holds the pieces of one length.

Defined cases. Null text counts as empty (one end id). Rows with a null or repeated id are packed
like any other row. Empty tables give empty results.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starfold.llm.common import pa_schema
from starfold.session import materialize

CAPACITY = 2048
END_ID = 0
GROUPS = 16
# Lengths up to capacity / share count as small. All shares are planned; the shortest plan is used.
SMALL_SHARES = (8, 4, 3, 2)
# Pre-tokens whose ids a task remembers.
CACHE_WORDS = 400_000
# What lies behind the Latin letters, and how special tokens begin.
BEYOND_LATIN = re.compile("[^\x00-\u024f]")
SPECIAL = "<|"
# The tokenizer's pre-token pattern, for lower-case texts of Latin characters; the first character decides between its cases.
LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u024f"
DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACES = " \t\n\x0b\x0c\r\x85\xa0"
PRE_TOKEN = re.compile(f"[{LETTERS}]+|[{DIGITS}]|'s|'t|'re|'ve|'m|'ll|'d|[^{LETTERS}{DIGITS}{SPACES}]+")

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


# ---------------------------------------------------------------------------------- tokens


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte: printable Latin-1
    bytes stand for themselves, the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class WordTokens(dict):
    """Token ids of the tokenizer's pre-tokens, as packed little-endian 32-bit numbers.

    The tokenizer lower-cases, cuts a text into pre-tokens (letters, single digits, other signs)
    and merges inside each, so a text's ids are those of its pre-tokens in order. Texts of Latin
    characters are cut here by the same pattern, and the ids of a pre-token are remembered; all
    other texts, and texts that name a special token, go through the tokenizer as a whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.tokenizer.model)
        self.letters = dict(enumerate(byte_letters()))

    def add(self, words: list[str]) -> None:
        mapped = [w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self.letters) for w in words]
        found = self.merges.encode(mapped, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, dtype="<u4").tobytes()
        cuts = (4 * np.searchsorted(np.array(found.word_ids), np.arange(len(words) + 1))).tolist()
        self.update((w, ids[cuts[k] : cuts[k + 1]]) for k, w in enumerate(words))

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def texts(self, texts: list[str]) -> Iterator[bytes]:
        split: list[list[str] | None] = []
        for text in texts:
            low = text.lower()
            latin = text.isascii() or (not BEYOND_LATIN.search(low) and is_normalized("NFC", text))
            split.append(PRE_TOKEN.findall(low) if latin and SPECIAL not in text else None)
        if len(self) > CACHE_WORDS:
            self.clear()
        new = set().union(*(w for w in split if w)).difference(self)
        if new:
            self.add(list(new))
        for text, words in zip(texts, split, strict=True):
            yield self.whole(text) if words is None else b"".join(map(self.__getitem__, words))


def tokenised_pieces(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece; `part` and `nth` number the pieces of each length within the task."""
    target = pa_schema(docs.sparkSession, PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(tokenizer_path)
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        end = np.uint32(END_ID).tobytes()
        for batch in batches:
            out: list[list] = [[] for _ in target]
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), tokens.texts(texts), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    length = len(cut) // 4
                    row = (doc, piece, at // 4, length, zlib.crc32(cut), part, seen[length])
                    seen[length] += 1
                    for col, v in zip(out, row, strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(out, target, strict=True)], schema=target
            )

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, PIECES)


# ---------------------------------------------------------------------------------- plan


class Bins:
    """Open sequences, grouped: equal content and equal room are one group with a count."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.by_room: dict[int, list[list]] = defaultdict(list)
        self.rooms: list[int] = []

    def put(self, room: int, count: int, items: tuple) -> None:
        """`items` is a linked list (length, rest) of what the sequences hold."""
        if not self.by_room[room]:
            insort(self.rooms, room)
        self.by_room[room].append([count, items])

    def _take(self, room: int, want: int) -> tuple[int, tuple]:
        groups = self.by_room[room]
        count, items = groups[-1]
        used = min(count, want)
        if used == count:
            groups.pop()
        else:
            groups[-1][0] -= used
        if not groups:
            self.rooms.pop(bisect_left(self.rooms, room))
        return used, items

    def best_fit(self, length: int, count: int) -> None:
        """Put `count` pieces of one length into the tightest room each, new sequences last."""
        while count:
            at = bisect_left(self.rooms, length)
            if at == len(self.rooms):
                each = self.capacity // length
                full, rest = divmod(count, each)
                for n, k in ((full, each), (1 if rest else 0, rest)):
                    if n:
                        items: tuple = ()
                        for _ in range(k):
                            items = (length, items)
                        self.put(self.capacity - k * length, n, items)
                return
            room = self.rooms[at]
            used, items = self._take(room, count)
            self.put(room - length, used, (length, items))
            count -= used

    def groups(self) -> Iterator[tuple[int, tuple]]:
        for room in self.rooms:
            for count, items in self.by_room[room]:
                yield count, items


def _knapsack(sizes: list[int], worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits, and its counts."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    for room in range(min(sizes), capacity + 1):
        best[room] = best[room - 1]
        for k, s in enumerate(sizes):
            if s <= room and best[room - s] + worth[k] > best[room] + 1e-12:
                best[room], took[room] = best[room - s] + worth[k], k
    counts, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if took[room] < 0:
            room -= 1
        else:
            counts[took[room]] += 1
            room -= sizes[took[room]]
    return float(best[capacity]), counts


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    """Whole multiples of the linear program's configurations: (times, counts per size)."""
    n = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.asarray(demand, dtype=float)
    for _ in range(40 * n):
        prices = np.linalg.solve(basis.T, np.ones(n))
        value, column = _knapsack(sizes, prices, capacity)
        if value <= 1 + 1e-7:
            break
        level, change = np.linalg.solve(basis, need), np.linalg.solve(basis, column)
        ratio = np.where(change > 1e-9, level / np.where(change > 1e-9, change, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    times = np.floor(np.linalg.solve(basis, need) + 1e-9).astype(np.int64)
    return [(int(t), [int(c) for c in basis[:, k]]) for k, t in enumerate(times) if t > 0]


def linear_groups(lengths: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """Cut (length, count) pairs, longest first, into groups of equal cardinality."""
    total = sum(c for _, c in lengths)
    out: list[list[tuple[int, int]]] = [[]]
    share, room = -(-total // groups), -(-total // groups)
    for length, count in lengths:
        while count:
            if not room:
                out.append([])
                room = share
            used = min(count, room)
            out[-1].append((length, used))
            room -= used
            count -= used
    return [g for g in out if g]


def plan_sequences(
    histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS
) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first number, end number, first sequence, offset) that cover the histogram."""
    plans = [_plan_with(histogram, capacity, groups, capacity // share) for share in SMALL_SHARES]
    bins = min(plans, key=lambda b: sum(count for count, _ in b.groups()))
    runs, number, sequence = [], defaultdict(int), 0
    for count, items in bins.groups():
        offset = 0
        while items:
            length, items = items
            runs.append((length, number[length], number[length] + count, sequence, offset))
            number[length] += count
            offset += length
        sequence += count
    return runs


def _plan_with(histogram: dict[int, int], capacity: int, groups: int, small: int) -> Bins:
    bins = Bins(capacity)
    left = {k: c for k, c in histogram.items() if c}
    if capacity in left:
        bins.put(0, left.pop(capacity), (capacity, ()))
    large = sorted(((k, c) for k, c in left.items() if k > small), reverse=True)
    if large:
        cut = linear_groups(large, groups)
        # Groups of one rounded size are one size.
        merged: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for g in cut:
            merged[g[0][0]].extend(g)
        sizes = sorted(merged, reverse=True)
        stock = [list(reversed(merged[s])) for s in sizes]  # the longest are taken from the end
        for times, counts in configurations(sizes, [sum(c for _, c in merged[s]) for s in sizes], capacity):
            while times:
                # As many equal sequences as the stock's runs of equal lengths allow.
                items: tuple = ()
                same, room = times, capacity
                picks: list[tuple[int, int, int]] = []
                for k, c in enumerate(counts):
                    at, need = len(stock[k]) - 1, c
                    while need and at >= 0:
                        length, have = stock[k][at]
                        used = min(need, have)
                        picks.append((k, length, used))
                        same = min(same, have // used)
                        need -= used
                        at -= 1
                for k, length, used in picks:
                    for _ in range(used):
                        items, room = (length, items), room - length
                if not picks:
                    break
                for k, length, used in reversed(picks):
                    at = next(i for i in range(len(stock[k]) - 1, -1, -1) if stock[k][i][0] == length)
                    have = stock[k][at][1] - used * same
                    stock[k][at] = (length, have)
                    if not have:
                        stock[k].pop(at)
                bins.put(room, same, items)
                times -= same
        rest: dict[int, int] = defaultdict(int)
        for runs in stock:
            for length, count in runs:
                rest[length] += count
        for length in sorted(rest, reverse=True):
            bins.best_fit(length, rest[length])
    for length in sorted((k for k in left if k <= small), reverse=True):
        bins.best_fit(length, left[length])
    return bins


# ---------------------------------------------------------------------------------- assignment


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """`pieces` (materialised, from `tokenised_pieces`) with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = materialize(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "packing-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = np.array(sorted(plan_sequences(histogram, capacity, groups)), dtype=np.int64).reshape(-1, 5)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(
        F.col("part").alias("p"), F.col("length").alias("l"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")
    )
    numbered = pieces.join(shift, (F.col("part") == F.col("p")) & (F.col("length") == F.col("l"))).select(
        *pieces.columns, (F.col("nth") + F.col("shift")).alias("number")
    )
    kept = [c for c in pieces.columns if c not in ("part", "nth")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name in kept)
    schema += ", sequence_id long, offset long"
    target = pa_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = plan[:, 0] << 40 | plan[:, 1]  # plan rows are sorted by (length, first number)
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            at = np.searchsorted(order, length << 40 | number, side="right") - 1
            found = plan[at]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array(found[:, 3] + number - found[:, 1]),
                    pa.array(found[:, 4]),
                ],
                schema=target,
            )

    return numbered.mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece."""
    pieces = materialize(tokenised_pieces(docs, tokenizer_path, id_col, text_col, capacity), "packing-pieces")
    return pack(pieces, capacity)
