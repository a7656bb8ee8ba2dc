"""Conversation repair by divide and conquer over four-state cost vectors.

A repaired conversation has the role initials `(s?(ua)+)?`. Reading it leaves one of four states: START, after a
system, a user or an assistant message; START and the last one may end it. Edits: Keep costs 0, Rerole (to user
or assistant) 2, Delete 3, Insert (an empty user or assistant message, anywhere) 2; a truncated row that stays
adds 1; blank and duplicate rows must go. The cheapest edits win, of equal ones those whose initials (D, I, K, R)
read least.

Method. The audit of a stretch of rows from one state to another ends with the edit of its last row; inserts
before a row belong to that row. So of two audits of one stretch neither is the beginning of the other, and they can be compared
by the first place where they differ. A forward vector holds, for each state, the least cost and the place that
its audit has among the four states' audits; a backward vector holds the costs to the goal. Both meet in the
middle of a stretch: the crossing of least cost, of these the one whose audit is least, is on the answer; both halves are solved in
the same way, in space linear in the rows.

In Spark:
1. Equal rows become one with a number of copies (summed before the shuffle), and the first row of every
   (conversation, role, text) is found by an aggregate and a join.
2. Rows are range-partitioned by conversation, turn, role and text, so a conversation of any length is spread over tasks,
   and cut into blocks of at most `BLOCK_ROWS` rows. A block gives its 4 x 4 costs and audit places.
3. The blocks of a conversation, a few numbers for thousands of rows, are folded in order; this gives each block's
   states at both ends.
4. Blocks with their states are repaired independently of each other.
5. Only the digest reads a conversation's repaired blocks in order, as a stream; a SHA-256 can't be put
   together from parts.

Defined cases. Null conversation ids are one conversation; null roles and texts are one space; rows without a turn come
first. Rows of one turn are ordered by role and text. Roles that begin with another letter can't be kept.
Repeated rows are duplicates after the first. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import ASCII_SPACE, pa_schema
from starfold.session import materialize

START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 50
# Inserts needed before a row that leads from one state to another; None where none help.
INSERTS = {
    (START, SYSTEM): 0, (START, USER): 0, (START, ASSISTANT): 1,
    (SYSTEM, USER): 0, (SYSTEM, ASSISTANT): 1,
    (USER, USER): 1, (USER, ASSISTANT): 0,
    (ASSISTANT, USER): 0, (ASSISTANT, ASSISTANT): 1,
}
# Inserts that end a conversation in each state.
CLOSING = (0, 2, 1, 0)
LEGAL = {"su", "ua", "au"}

# Codes of rows: 0 must go, else 1 + 2 * initial (place in "sua", 3 for others) + truncated.
BLOCK_ROWS = 2048
BLOCK_CHARS = 1 << 22

Vector = tuple[tuple[int, ...], tuple[int, ...]]


def row_code(role: str, truncated: bool) -> int:
    place = "sua".find(role[:1]) if role else -1
    return 1 + 2 * (3 if place < 0 else place) + truncated


@lru_cache(maxsize=None)
def edits(code: int) -> tuple[tuple[int, int, int, str], ...]:
    """(from, to, cost, audit) of all useful edits of a row, inserts before it included."""
    out = [(p, p, 3, "D") for p in range(4)]
    if code:
        initial, truncated = divmod(code - 1, 2)
        for (p, q), k in INSERTS.items():
            if initial + 1 == q:
                out.append((p, q, 2 * k + truncated, "I" * k + "K"))
            elif q != SYSTEM:
                out.append((p, q, 2 * k + 2 + truncated, "I" * k + "R"))
    return tuple(out)


def settle(found: dict[int, tuple[int, int, object]]) -> tuple[list[int], list[int]]:
    """Costs and audit places of {state: (cost, place of the audit's beginning, the rest)}."""
    order = sorted(found, key=lambda q: found[q][1:])
    costs, places = [FAR] * 4, [0] * 4
    for place, q in enumerate(order):
        costs[q], places[q] = found[q][0], place
    return costs, places


@lru_cache(maxsize=200_000)
def step(vector: Vector, code: int) -> tuple[int, Vector]:
    """The forward vector after one more row: what all costs have in common, and the rest."""
    costs, places = vector
    found: dict[int, tuple[int, int, object]] = {}
    for p, q, cost, audit in edits(code):
        if costs[p] < FAR:
            option = (costs[p] + cost, places[p], audit)
            if q not in found or option < found[q]:
                found[q] = option
    new, order = settle(found)
    base = min(new)
    return base, (tuple(c if c == FAR else c - base for c in new), tuple(order))


@lru_cache(maxsize=200_000)
def step_back(costs: tuple[int, ...], code: int) -> tuple[int, tuple[int, ...]]:
    """Costs to the goal before a row, from those after it."""
    new = [FAR] * 4
    for p, q, cost, _ in edits(code):
        if costs[q] < FAR:
            new[p] = min(new[p], costs[q] + cost)
    base = min(new)
    return base, tuple(c if c == FAR else c - base for c in new)


def single(state: int) -> tuple[int, ...]:
    return tuple(0 if q == state else FAR for q in range(4))


def forward(codes: bytes, lo: int, hi: int, state: int) -> tuple[int, Vector]:
    total, vector = 0, (single(state), (0, 0, 0, 0))
    for i in range(lo, hi):
        base, vector = step(vector, codes[i])
        total += base
    return total, vector


def solve(codes: bytes, lo: int, hi: int, start: int, goal: int, out: list[tuple[int, str]]) -> None:
    """Append (state before, audit) of rows lo..hi on the least audit of the cheapest edits."""
    if hi - lo == 1:
        _, audit = min((c, a) for p, q, c, a in edits(codes[lo]) if p == start and q == goal)
        out.append((start, audit))
        return
    mid = (lo + hi) // 2
    _, (ahead, places) = forward(codes, lo, mid, start)
    back = single(goal)
    for i in range(hi - 1, mid - 1, -1):
        _, back = step_back(back, codes[i])
    cross = min(range(4), key=lambda q: (min(ahead[q] + back[q], FAR), places[q]))
    solve(codes, lo, mid, start, cross, out)
    solve(codes, mid, hi, cross, goal, out)


def compose(vector: Vector, costs: list[int], places: list[int]) -> tuple[list[int], list[int], bytes]:
    """A forward vector carried over a block, and the state before the block for each state after it."""
    found: dict[int, tuple[int, int, object]] = {}
    before = bytearray(4)
    for p in range(4):
        for q in range(4):
            if (cost := vector[0][p] + costs[4 * p + q]) < FAR:
                option = (cost, vector[1][p], places[4 * p + q])
                if q not in found or option < found[q]:
                    found[q] = option
                    before[q] = p
    new, order = settle(found)
    return new, order, bytes(before)


def messages_of(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): equal rows once, with the number of copies."""
    copies = F.col("copies") if "copies" in df.columns else F.lit(1)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = df.select("conv_id", F.col("turn").cast("long").alias("turn"), blank("role"), blank("text"), copies.alias("n"))
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))


def with_faults(items: DataFrame) -> DataFrame:
    """Items with blank, first (no earlier row has the role and text) and truncated."""
    trimmed = F.rtrim(F.col("text"), F.lit(ASCII_SPACE))
    marked = items.withColumn("blank", trimmed == "").withColumn(
        "truncated", ~F.substring(trimmed, -1, 1).isin(".", "!", "?")
    )
    repeated = (
        marked.where(~F.col("blank"))
        .groupBy("conv_id", "role", "text")
        .agg(F.min(F.struct("turn")).alias("least"), F.count(F.lit(1)).alias("times"))
        .where("times > 1")
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text").alias("t"), "least")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text") == F.col("t"))
    later = F.col("least").isNotNull() & ~F.col("least")["turn"].eqNullSafe(F.col("turn"))
    return marked.join(repeated, same, "left").select(*items.columns, "blank", "truncated", (~later).alias("first"))


class Block:
    """Rows of one conversation in a task, up to BLOCK_ROWS of them."""

    def __init__(self, conv: object, part: int, number: int) -> None:
        self.conv, self.part, self.number = conv, part, number
        self.codes = bytearray()
        self.copies: list[int] = []
        self.roles: list[str] = []
        self.texts: list[str | None] = []
        self.chars = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None
        self.first_initial = self.last_initial = ""

    def add(self, turn, role: str, text: str, n: int, blank: bool, truncated: bool, first: bool) -> None:
        stays = first and not blank
        self.codes.append(row_code(role, truncated) if stays else 0)
        self.copies.append(n)
        self.roles.append(role)
        self.texts.append(text if stays else None)
        self.chars += len(text)
        self.blank += n * blank
        self.duplicate += 0 if blank else n - first
        self.truncated += stays and truncated
        initial = role[:1]
        if len(self.codes) > 1:
            self.illegal += self.last_initial + initial not in LEGAL
        else:
            self.first_initial = initial
        self.illegal += n - 1
        self.last_initial = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn

    def row(self) -> dict[str, object]:
        codes = bytes(self.codes)
        extra = 3 * (sum(self.copies) - len(self.copies))
        costs: list[int] = []
        places: list[int] = []
        for state in range(4):
            total, (ahead, order) = forward(codes, 0, len(codes), state)
            costs.extend(FAR if c == FAR else c + total + extra for c in ahead)
            places.extend(order)
        keep = ("part", "number", "copies", "roles", "texts", "blank", "duplicate", "truncated", "illegal", "turns")
        out = {k: getattr(self, k) for k in (*keep, "first_turn", "last_turn", "first_initial", "last_initial")}
        return {"conv_id": self.conv, "codes": codes, "costs": costs, "places": places, **out}


COUNTS = "blank long, duplicate long, truncated long, illegal long, turns long, first_turn long, last_turn long, first_initial string, last_initial string"
EDGES = "costs array<long>, places array<int>"


def to_batches(rows: Iterable[dict], target: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema=target)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=target)


def from_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def blocks_of(items: DataFrame, block_rows: int) -> DataFrame:
    """One row per block: its rows, counts, costs and audit places."""
    conv = items.schema["conv_id"].dataType.simpleString()
    ddl = (
        f"conv_id {conv}, part int, number int, codes binary, copies array<long>, roles array<string>, "
        f"texts array<string>, {COUNTS}, {EDGES}"
    )
    target = pa_schema(items.sparkSession, ddl)

    def cut(rows: Iterator[dict]) -> Iterator[dict]:
        block = None
        for r in rows:
            same = block is not None and block.conv == r["conv_id"]
            if not same or len(block.codes) == block_rows or block.chars > BLOCK_CHARS:
                if block is not None:
                    yield block.row()
                block = Block(r["conv_id"], r["part"], block.number + 1 if same else 0)
            block.add(r["turn"], r["role"], r["text"], r["n"], r["blank"], r["truncated"], r["first"])
        if block is not None:
            yield block.row()

    order = ["conv_id", "turn", "role", "text"]
    placed = items.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    return placed.mapInArrow(lambda it: to_batches(cut(from_batches(it)), target, 32), ddl)


def folded(blocks: DataFrame) -> DataFrame:
    """Per block the states before and after it; at a conversation's last block also the totals."""
    conv = blocks.schema["conv_id"].dataType.simpleString()
    ddl = (
        f"conv_id {conv}, part int, number int, before int, after int, closing int, cost long, gaps long, "
        "blank long, duplicate long, truncated long, illegal long"
    )
    target = pa_schema(blocks.sparkSession, ddl)

    def close(conv, vector, totals, path: list[bytes], places: list[tuple[int, int]]) -> Iterator[dict]:
        end = min(range(4), key=lambda q: (vector[0][q] + 2 * CLOSING[q], vector[1][q]))
        totals["cost"] = vector[0][end] + 2 * CLOSING[end]
        spread = 0 if totals["last"] is None else totals["last"] - totals["least"] + 1 - totals["turns"]
        totals["gaps"] = min(spread, (1 << 63) - 1)
        totals["closing"] = CLOSING[end]
        last = True
        state = end
        for before, (part, number) in zip(reversed(path), reversed(places), strict=True):
            row = {"conv_id": conv, "part": part, "number": number, "before": before[state], "after": state}
            yield {**row, **{k: v for k, v in totals.items() if k in target.names}} if last else row
            last, state = False, before[state]

    def fold(rows: Iterator[dict]) -> Iterator[dict]:
        conv = vector = totals = None
        path: list[bytes] = []
        places: list[tuple[int, int]] = []
        for r in rows:
            if totals is None or r["conv_id"] != conv:
                if totals is not None:
                    yield from close(conv, vector, totals, path, places)
                conv, path, places = r["conv_id"], [], []
                vector = (single(START), (0, 0, 0, 0))
                totals = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
                totals |= {"least": None, "last": None, "initial": None}
            for k in ("blank", "duplicate", "truncated", "illegal", "turns"):
                totals[k] += r[k]
            if totals["initial"] is not None:
                totals["illegal"] += totals["initial"] + r["first_initial"] not in LEGAL
            totals["initial"] = r["last_initial"]
            if r["first_turn"] is not None:
                totals["turns"] -= totals["last"] == r["first_turn"]
                totals["least"] = r["first_turn"] if totals["least"] is None else totals["least"]
                totals["last"] = r["last_turn"]
            costs, order, before = compose(vector, r["costs"], r["places"])
            vector = (costs, order)
            path.append(before)
            places.append((r["part"], r["number"]))
        if totals is not None:
            yield from close(conv, vector, totals, path, places)

    small = blocks.drop("codes", "copies", "roles", "texts")
    placed = small.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number")
    return placed.mapInArrow(lambda it: to_batches(fold(from_batches(it)), target, 4096), ddl)


NEXT_ROLE = ("user", "user", "assistant", "user")
AFTER_INSERT = (USER, USER, ASSISTANT, USER)


def written(codes: bytes, copies, roles, texts, before: int, after: int, closing: int) -> Iterator[tuple[str, str | None, str | None]]:
    """(edit, role, text) of each edit of a block; role and text are None for deleted rows."""
    path: list[tuple[int, str]] = []
    solve(codes, 0, len(codes), before, after, path)
    for i, (state, audit) in enumerate(path):
        for edit in audit:
            if edit == "D":
                yield "D", None, None
            elif edit == "I":
                yield "I", NEXT_ROLE[state], ""
                state = AFTER_INSERT[state]
            else:
                yield edit, roles[i] if edit == "K" else NEXT_ROLE[state], texts[i]
        for _ in range(copies[i] - 1):
            yield "D", None, None
    state = after
    for _ in range(closing):
        yield "I", NEXT_ROLE[state], ""
        state = AFTER_INSERT[state]


def repaired_blocks(messages: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(conv_id, part, number, edits, messages, counts): every block's audit and repaired messages, in
    order of part and number; cost and counts at the last block of each conversation."""
    items = materialize(with_faults(messages_of(messages)), "repair-items")
    blocks = materialize(blocks_of(items, block_rows), "repair-blocks")
    ends = folded(blocks)
    totals = ["cost", "gaps", "blank", "duplicate", "truncated", "illegal"]
    conv = blocks.schema["conv_id"].dataType.simpleString()
    ddl = (
        f"conv_id {conv}, part int, number int, edits string, messages array<struct<role string, text string>>, "
        + ", ".join(f"{c} long" for c in totals)
    )
    target = pa_schema(blocks.sparkSession, ddl)

    def write(rows: Iterator[dict]) -> Iterator[dict]:
        for r in rows:
            done = list(
                written(r["codes"], r["copies"], r["roles"], r["texts"], r["before"], r["after"], r["closing"] or 0)
            )
            yield {
                **{k: r[k] for k in ("conv_id", "part", "number", *totals)},
                "edits": "".join(e for e, _, _ in done),
                "messages": [{"role": a, "text": b} for _, a, b in done if a is not None],
            }

    own = blocks.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("number").alias("k"), "codes", "copies", "roles", "texts")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("number") == F.col("k"))
    joined = ends.join(own, same).drop("c", "p", "k")
    return joined.mapInArrow(lambda it: to_batches(write(from_batches(it)), target, 32), ddl)


def repaired_messages(messages: DataFrame) -> DataFrame:
    """(conv_id, part, number, pos, role, text): the repaired conversations, in order of part, number and pos."""
    found = repaired_blocks(messages)
    out = found.select("conv_id", "part", "number", F.posexplode("messages").alias("pos", "m"))
    return out.select("conv_id", "part", "number", "pos", "m.role", "m.text")


def repair_digest(messages: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)."""
    found = repaired_blocks(messages, block_rows)
    conv = found.schema["conv_id"].dataType.simpleString()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    ddl = f"conv_id {conv}, " + ", ".join(f"{c} long" for c in counts) + ", audit string, repaired_sha256 string"
    target = pa_schema(found.sparkSession, ddl)

    def digest(rows: Iterator[dict]) -> Iterator[dict]:
        sha, audit, any_line = hashlib.sha256(), [], False
        for r in rows:
            audit.append(r["edits"])
            for m in r["messages"]:
                sha.update((("\n" if any_line else "") + m["role"] + ":" + m["text"]).encode())
                any_line = True
            if r["cost"] is not None:
                yield {
                    **{k: r[k] for k in ("conv_id", *counts)},
                    "audit": "".join(audit),
                    "repaired_sha256": sha.hexdigest(),
                }
                sha, audit, any_line = hashlib.sha256(), [], False

    placed = found.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number")
    return placed.mapInArrow(lambda it: to_batches(digest(from_batches(it)), target, 1024), ddl)


def repair_conversations(
    messages: DataFrame, original: DataFrame | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """`repair_digest`, and a row of zeros for each conversation of `original` that has no messages."""
    done = repair_digest(messages, block_rows)
    if original is None:
        return done
    ids = original.select(F.col("conv_id").alias("id")).distinct()
    joined = ids.join(done, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        F.col("id").alias("conv_id"),
        *zero,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def damaged(df: DataFrame) -> DataFrame:
    """Rows with faults put in by their own hash: (conv_id, turn, role, text, copies)."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key: Column = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    role, text = text_of("role"), text_of("text")
    return (
        df.select("conv_id", "turn", role.alias("role"), text.alias("text"), key.alias("k"))
        .where("k <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("k") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(F.col("k") == 1, F.lit(""))
            .when(F.col("k") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.when(F.col("k") == 3, 2).otherwise(1).alias("copies"),
        )
    )
