"""Tool-call linking for chat data.

Messages have (conv_id, turn, role, content, calls, result_of): `calls` are the tool calls that a
message makes, an array of (id, name, arguments), arguments as JSON text; `result_of` is the
call id that a tool message answers.

Method.
1. Calls and results are hash-joined by (conversation, identifier). The first result of a call (by
   turn) is its result; later ones and results without a call are marked as orphans.
2. A call depends on the calls whose identifiers its arguments name as {"$ref": id}. Calls are
   ordered topologically: calls whose references are all placed get the next level. Conversations
   of up to `TASK_EDGES` references are ordered inside tasks, longer ones by longest paths that double in
   rounds of joins over all of them at once. Calls on a cycle, and references to unknown calls, are marked.
3. Arguments are validated against the JSON schema of the tool.
4. Every message, call and result is serialised as canonical JSON: keys sorted, no white space,
   UTF-8, floats in shortest form.

The result has one row per item, with columns that order it: (conv_id, turn, level, kind, call id).
A result takes the place after its call. No conversation is collected into one task, whatever its length;
joins are on (conversation, identifier) and may be split by Spark.

Defined cases. Null content is JSON null. Null call ids and null `result_of` link with nothing. Null
conversation ids are one conversation. Of repeated calls with one identifier the first (by turn, then
name and arguments) counts, the others are marked `duplicate`. Arguments that are no JSON object are
invalid, as are ones with half a surrogate pair, which no UTF-8 text can hold, and ones nested deeper than Python's
parser goes. Tools without a schema are invalid. Empty tables give empty results.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starfold.llm.common import map_rows
from starfold.operators.paths import longest_paths
from starfold.session import materialize

# References of a conversation that are ordered inside one task.
TASK_EDGES = 10_000

MESSAGE = "conv_id long, turn long, role string, content string, calls array<struct<id:string,name:string,arguments:string>>, result_of string"
CHECKED = "conv_id long, turn long, id string, name string, arguments string, canonical string, problem string, refs array<string>"
TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}


def canonical(value: Any) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def schema_problem(value: Any, schema: dict, path: str = "$") -> str | None:
    """The first way in which a value breaks a JSON schema (types, enum, required, properties,
    additionalProperties, items, minimum, maximum, minLength, maxLength), or None."""
    kinds = schema.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        fits = any(isinstance(value, TYPES[k]) and not (k in ("integer", "number") and isinstance(value, bool)) for k in kinds)
        if not fits:
            return f"{path}: not {'/'.join(kinds)}"
    if "enum" in schema and value not in schema["enum"]:
        return f"{path}: not one of the listed values"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            return f"{path}: out of range"
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        return f"{path}: length"
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in schema.get("required", ()):
            if name not in value:
                return f"{path}.{name}: missing"
        for name in sorted(value):
            if name in known:
                found = schema_problem(value[name], known[name], f"{path}.{name}")
                if found:
                    return found
            elif schema.get("additionalProperties") is False:
                return f"{path}.{name}: not allowed"
    if isinstance(value, list) and "items" in schema:
        for k, x in enumerate(value):
            found = schema_problem(x, schema["items"], f"{path}[{k}]")
            if found:
                return found
    return None


def references(value: Any) -> set[str]:
    """Identifiers named as {"$ref": id} anywhere in a value."""
    if isinstance(value, dict):
        if set(value) == {"$ref"} and isinstance(value["$ref"], str):
            return {value["$ref"]}
        return set().union(*map(references, value.values()))
    if isinstance(value, list):
        return set().union(*map(references, value))
    return set()


def check_call(name: str | None, arguments: str | None, schemas: dict[str, dict]) -> tuple[str | None, str | None, list[str]]:
    """(canonical arguments, problem, references) of a call."""
    try:
        value = json.loads(arguments) if arguments is not None else None
        text = canonical(value)
        text.encode()
        if not isinstance(value, dict):
            return text, "arguments are no object", []
        problem = schema_problem(value, schemas[name]) if name in schemas else "unknown tool"
        return text, problem, sorted(references(value))
    except UnicodeEncodeError:
        return None, "arguments hold half a surrogate pair", []
    except ValueError:
        return None, "arguments are no JSON", []
    except RecursionError:
        return None, "arguments are nested too deeply", []


def checked_calls(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    def make():
        def batch(cols: dict) -> dict:
            done = [check_call(n, a, schemas) for n, a in zip(cols["name"], cols["arguments"], strict=True)]
            out = {k: cols[k] for k in ("conv_id", "turn", "id", "name", "arguments")}
            for k, name in enumerate(("canonical", "problem", "refs")):
                out[name] = [d[k] for d in done]
            return out

        return batch

    return map_rows(messages.select("conv_id", "turn", F.explode("calls").alias("c")).select("conv_id", "turn", "c.*"), make, CHECKED)


def call_levels(edges: list[tuple[str, str]]) -> dict[str, int]:
    """Level of every call on an edge (id, ref) that can be ordered: 0 without references."""
    waiting: dict[str, int] = {}
    users: dict[str, list[str]] = {}
    for call, ref in edges:
        waiting[call] = waiting.get(call, 0) + 1
        waiting.setdefault(ref, 0)
        users.setdefault(ref, []).append(call)
    levels, ready, level = {}, [c for c, n in waiting.items() if not n], 0
    while ready:
        following = []
        for call in ready:
            levels[call] = level
            for user in users.get(call, ()):
                waiting[user] -= 1
                if not waiting[user]:
                    following.append(user)
        ready, level = following, level + 1
    return levels


def _levels_in_tasks(edges: DataFrame) -> DataFrame:
    """(conv_id, id, level) of conversations with few references, one row of edges each."""

    def make():
        def batch(cols: dict) -> dict:
            done = [call_levels([(e["id"], e["ref"]) for e in edges]) for edges in cols["edges"]]
            return {
                "conv_id": cols["conv_id"],
                "levels": [[{"id": k, "level": v} for k, v in d.items()] for d in done],
            }

        return batch

    rows = edges.groupBy("conv_id").agg(F.collect_list(F.struct("id", "ref")).alias("edges"))
    out = map_rows(rows, make, "conv_id long, levels array<struct<id:string,level:int>>")
    return out.select("conv_id", F.inline("levels"))


def _levels_in_rounds(edges: DataFrame) -> DataFrame:
    """The same for any number of references, as longest paths that double in rounds of joins."""
    def name(call: str) -> Column:
        return F.to_json(F.struct("conv_id", F.col(call).alias("id")))

    ends = edges.select("conv_id", "id").unionByName(edges.select("conv_id", F.col("ref").alias("id"))).distinct()
    nodes = materialize(ends.withColumn("node", name("id")), "tool-nodes")
    links = edges.select(name("id").alias("id"), name("ref").alias("pred"), F.lit(1).alias("w"))
    found = longest_paths(nodes.select(F.col("node").alias("id"), F.lit(0).alias("base")), links, limit=nodes.count())
    found = found.select(F.col("id").alias("node"), F.col("value").cast("int").alias("level"))
    return nodes.join(found, "node").select("conv_id", "id", "level")


def _placed(calls: DataFrame) -> DataFrame:
    """(conv_id, id, level) of the calls that can be ordered. `calls` has one row per identifier."""
    known = calls.select(F.col("conv_id").alias("c2"), F.col("id").alias("r2"))
    edges = materialize(
        calls.select("conv_id", "id", F.explode("refs").alias("ref"))
        .join(known, F.col("conv_id").eqNullSafe(F.col("c2")) & (F.col("ref") == F.col("r2")))
        .select("conv_id", "id", "ref"),
        "tool-edges",
    )
    large = edges.groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > TASK_EDGES)
    large = materialize(large.select(F.col("conv_id").alias("c3")), "tool-large")
    here = F.col("conv_id").eqNullSafe(F.col("c3"))
    levels = _levels_in_tasks(edges.join(large, here, "left_anti")).unionByName(
        _levels_in_rounds(edges.join(large, here, "left_semi"))
    )
    levels = materialize(levels, "tool-levels")
    linked = edges.select("conv_id", "id").unionByName(edges.select("conv_id", F.col("ref").alias("id"))).distinct()
    linked = linked.select(F.col("conv_id").alias("c2"), F.col("id").alias("i2"))
    same = F.col("conv_id").eqNullSafe(F.col("c2")) & (F.col("id") == F.col("i2"))
    free = calls.select("conv_id", "id").join(linked, same, "left_anti").withColumn("level", F.lit(0))
    return free.unionByName(levels)


def link_tools(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """(conv_id, turn, level, kind, call_id, status, json), one row per message, call and result.

    kind: 0 message, 1 call, 2 result. status: ok, or what is wrong. The order of a conversation is
    (turn, level, call_id, kind); a result carries the turn and level of its call.
    """
    messages = materialize(messages.select("conv_id", "turn", "role", "content", "calls", "result_of"), "tool-messages")
    calls = checked_calls(messages, schemas)
    first = Window.partitionBy("conv_id", "id").orderBy("turn", "name", "arguments")
    calls = materialize(
        calls.withColumn("nth", F.when(F.col("id").isNull(), 1).otherwise(F.row_number().over(first))), "tool-calls"
    )
    unique = calls.where("nth = 1 and id is not null")
    placed = _placed(unique).select(F.col("conv_id").alias("c2"), F.col("id").alias("i2"), "level")
    known = unique.select(F.col("conv_id").alias("c3"), F.col("id").alias("r3"))
    asked = unique.select("conv_id", "id", F.explode("refs").alias("ref"))
    unknown = (
        asked.join(known, F.col("conv_id").eqNullSafe(F.col("c3")) & (F.col("ref") == F.col("r3")), "left_anti")
        .select(F.col("conv_id").alias("c4"), F.col("id").alias("i4"))
        .distinct()
        .withColumn("unknown", F.lit(True))
    )
    results = messages.where("result_of is not null")
    order = Window.partitionBy("conv_id", "result_of").orderBy("turn", "content")
    results = results.withColumn("nth", F.row_number().over(order))
    answered = materialize(
        results.select("conv_id", F.col("turn").alias("result_turn"), "content", F.col("result_of").alias("call_id"), "nth"), "tool-results"
    )
    have = answered.where("nth = 1").select(F.col("conv_id").alias("c5"), F.col("call_id").alias("i5")).withColumn("answered", F.lit(True))
    rows = (
        calls.join(placed, F.col("conv_id").eqNullSafe(F.col("c2")) & (F.col("id") == F.col("i2")), "left")
        .join(unknown, F.col("conv_id").eqNullSafe(F.col("c4")) & (F.col("id") == F.col("i4")), "left")
        .join(have, F.col("conv_id").eqNullSafe(F.col("c5")) & (F.col("id") == F.col("i5")), "left")
    )
    status = (
        F.when(F.col("id").isNull(), "no identifier")
        .when(F.col("nth") > 1, "duplicate")
        .when(F.col("problem").isNotNull(), F.col("problem"))
        .when(F.col("unknown"), "unknown reference")
        .when(F.col("level").isNull(), "cycle")
        .when(F.col("answered").isNull(), "no result")
        .otherwise("ok")
    )
    calls_out = rows.select("conv_id", "turn", F.when(F.col("nth") == 1, F.col("level")).alias("level"), F.lit(1).alias("kind"),
                            F.col("id").alias("call_id"), status.alias("status"), F.lit("assistant").alias("role"), "name", "canonical",
                            F.lit(None).cast("string").alias("content"))
    of = unique.join(placed, F.col("conv_id").eqNullSafe(F.col("c2")) & (F.col("id") == F.col("i2")), "left").select(
        F.col("conv_id").alias("c6"), F.col("id").alias("i6"), F.col("turn").alias("call_turn"), "level", "name"
    )
    results_out = answered.join(of, F.col("conv_id").eqNullSafe(F.col("c6")) & (F.col("call_id") == F.col("i6")), "left").select(
        "conv_id", F.when((F.col("nth") == 1) & F.col("call_turn").isNotNull(), F.col("call_turn")).otherwise(F.col("result_turn")).alias("turn"),
        "level", F.lit(2).alias("kind"), "call_id",
        F.when(F.col("i6").isNull(), "orphan").when(F.col("nth") > 1, "duplicate").otherwise("ok").alias("status"),
        F.lit("tool").alias("role"), "name", F.lit(None).cast("string").alias("canonical"), "content",
    )
    plain = messages.where("result_of is null").select(
        "conv_id", "turn", F.lit(None).cast("int").alias("level"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("call_id"),
        F.lit("ok").alias("status"), "role", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("canonical"), "content",
    )
    return serialise(plain.unionByName(calls_out).unionByName(results_out))


ITEMS = "conv_id long, turn long, level int, kind int, call_id string, status string, json string"


def item_json(kind: int, role: str | None, call_id: str | None, name: str | None, arguments: str | None, content: str | None) -> str:
    if kind == 1:
        call = {"id": call_id, "name": name, "arguments": json.loads(arguments) if arguments is not None else None}
        return canonical({"role": role, "tool_call": call})
    if kind == 2:
        return canonical({"role": role, "tool_call_id": call_id, "name": name, "content": content})
    return canonical({"role": role, "content": content})


def serialise(items: DataFrame) -> DataFrame:
    def make():
        def batch(cols: dict) -> dict:
            out = {k: cols[k] for k in ("conv_id", "turn", "level", "kind", "call_id", "status")}
            out["json"] = [
                item_json(*x) for x in zip(*(cols[k] for k in ("kind", "role", "call_id", "name", "canonical", "content")), strict=True)
            ]
            return out

        return batch

    return map_rows(items, make, ITEMS)


# ------------------------------------------------------------------------------ plain chats

# The tool that plain question-and-answer chats are read as.
REPLY_SCHEMA = {
    "type": "object",
    "required": ["turn", "text"],
    "additionalProperties": False,
    "properties": {
        "turn": {"type": "integer", "minimum": 0},
        "text": {"type": "string", "minLength": 1},
        "after": {"type": "object"},
    },
}


def plain_chats(chats: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) chats as messages with calls: a user's message asks the tool
    `reply`, the following assistant message is its result, and a question refers to the question
    two turns before it."""
    call_id = F.concat_ws("-", F.lit("q"), F.col("turn").cast("string"))
    arguments = F.to_json(
        F.struct(
            F.col("turn"),
            F.coalesce("text", F.lit("")).alias("text"),
            F.when(F.col("turn") >= 2, F.struct(F.concat_ws("-", F.lit("q"), (F.col("turn") - 2).cast("string")).alias("$ref"))).alias("after"),
        )
    )
    call = F.struct(call_id.alias("id"), F.lit("reply").alias("name"), arguments.alias("arguments"))
    return chats.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        F.col("text").alias("content"),
        F.when(F.col("role") == "user", F.array(call)).alias("calls"),
        F.when(F.col("role") == "assistant", F.concat_ws("-", F.lit("q"), (F.col("turn") - 1).cast("string"))).alias("result_of"),
    )
