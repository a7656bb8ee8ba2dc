"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from starfold.llm import chat_repair
from starfold.llm.common import prepare
from starfold.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, part string, n long, copies_ string"
SPACE = " \t\n\x0b\x0c\r"
NEXT = {0: "su", 1: "u", 2: "a", 3: "u"}
STATE = {"s": 1, "u": 2, "a": 3}


def brute(rows):
    """(blank, duplicate, truncated, illegal, cost, audit, lines) of (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        kind = "blank" if not body.lstrip(SPACE) else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(kind)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))

    @lru_cache(None)
    def best(i, state, inserted):
        options = [(0, "", ())] if i == len(rows) and state in (0, 3) else []
        if inserted < 3:
            for c in NEXT[state].replace("s", ""):
                cost, audit, lines = best(i, STATE[c], inserted + 1)
                options.append((cost + 2, "I" + audit, ({"u": "user:", "a": "assistant:"}[c],) + lines))
        if i < len(rows):
            _, role, text = rows[i]
            cost, audit, lines = best(i + 1, state, 0)
            options.append((cost + 3, "D" + audit, lines))
            if faults[i] in ("", "truncated"):
                extra = faults[i] == "truncated"
                for c in NEXT[state]:
                    cost, audit, lines = best(i + 1, STATE[c], 0)
                    if role[:1] == c:
                        options.append((cost + extra, "K" + audit, (f"{role}:{text}",) + lines))
                    if c != "s":
                        name = {"u": "user", "a": "assistant"}[c]
                        options.append((cost + extra + 2, "R" + audit, (f"{name}:{text}",) + lines))
        return min(options, key=lambda o: o[:2], default=(10**9, "", ()))

    for i in range(len(rows), -1, -20):
        for state in range(4):
            best(i, state, 0)
    cost, audit, lines = best(0, 0, 0)
    assert best.cache_info().misses < 10**6
    count = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
    return [*count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()]


def expected(rows):
    """The query's rows, by conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        held = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            show = lambda v: " " if v is None else str(v)
            kind = zlib.crc32(f"{show(c)}:{show(turn)}".encode()) % 20
            role, text = show(role), show(text)
            if kind == 0:
                continue
            if kind == 1:
                text = ""
            if kind == 2:
                text = re.sub("[.!?]", "", text)
            if kind == 4:
                role = "user"
            held += [(turn, role, text)] * (2 if kind == 3 else 1)
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [r[0] for r in held if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = [gaps, *(brute(tuple(held)) if held else [0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()])]
    return out


def make_rows(rng, convs, longest):
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "unknown"]
    texts = ["Yes.", "no", "What?", "", " \t", None, "same words.", "ends! \n", "über", "a b c."]
    rows = []
    for c in convs:
        for t in range(rng.randint(1, longest)):
            turn = rng.choice([t, t, t, t + 5, None, rng.randint(0, 4)])
            rows.append((c, turn, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"text {t}."))
    return rows


def found(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: [r[n] for n in names] for r in df.collect()}


def run(spark, rows, block=2048):
    df = prepare(spark).createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    return chat_repair.repair_conversations(chat_repair.damaged(df), df, block)


@pytest.mark.parametrize("block", [1, 3, 2048])
def test_repair_is_the_cheapest_and_least(spark, block):
    """Blocks of any size give what a search over all edits gives."""
    rng = random.Random(block)
    rows = make_rows(rng, [*range(150), None], 14)
    rows += rng.sample(rows, 60)
    assert found(run(spark, rows, block)) == expected(rows)


def test_solve_on_single_stretches():
    """All sequences of up to four row codes, cut at every place."""
    rng = random.Random(3)
    for _ in range(400):
        codes = bytes(rng.randrange(9) for _ in range(rng.randint(1, 7)))
        total, (costs, places) = chat_repair.forward(codes, 0, len(codes), 0)
        for goal in range(4):
            if costs[goal] >= chat_repair.FAR:
                continue
            out = []
            chat_repair.solve(codes, 0, len(codes), 0, goal, out)
            state, cost = 0, 0
            for code, (before, audit) in zip(codes, out):
                assert before == state
                options = [(c, q) for p, q, c, a in chat_repair.edits(code) if p == state and a == audit]
                cost, state = cost + options[0][0], options[0][1]
            assert (cost, state) == (total + costs[goal], goal)


def test_long_conversation_with_copies(spark):
    """One conversation holds most rows, over many blocks, with repeated rows."""
    rng = random.Random(9)
    rows = make_rows(rng, [7], 9)[:4] + [(7, t, rng.choice(["user", "assistant"]), rng.choice(["hi.", f"t{t}"])) for t in range(700)]
    rows += [(7, 3, "user", "copy.")] * 300 + [(8, 1, "user", "hello.")]
    assert found(run(spark, rows, 64)) == expected(rows)


def test_messages_and_empty_table(spark):
    df = spark.createDataFrame([(1, 1, "user", "a."), (1, 2, "user", "b.")], "conv_id long, turn long, role string, text string")
    rows = chat_repair.repaired_messages(df).orderBy("part", "number", "pos").collect()
    assert [(r.role, r.text) for r in rows] == [("user", "a."), ("assistant", "b.")]
    none = df.where("conv_id = 5")
    assert chat_repair.repair_conversations(chat_repair.damaged(none), none).count() == 0


def test_query_on_given_table(spark):
    """A part of the conversations against the search, all of them for their number."""
    sf = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = found(QUERIES["op11_chat_repair"](spark, sf))
    assert len(got) == df.select("conv_id").distinct().count()
    assert got == expected(rows)
