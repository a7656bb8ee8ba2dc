"""Cases that structural hashes and plain recursion get wrong."""

import json

import pytest

from starfold.llm import chat_tools, near_dup
from starfold.llm.common import prepare


def test_thue_morse_words_are_two_documents(spark):
    """A word and its complement collide under polynomial hashes modulo 2^64."""
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    docs = prepare(spark).createDataFrame([(1, word), (2, other), (3, word)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs, size=3, percent=85).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


CALL = "conv_id long, turn long, role string, content string, calls array<struct<id:string,name:string,arguments:string>>, result_of string"


def test_arguments_that_no_text_can_hold(spark):
    deep = "[" * 100_000 + "]" * 100_000
    calls = [("a", "t", '{"text":"\\ud800"}'), ("b", "t", f'{{"x":{deep}}}'), ("c", "t", '{"text":"ok"}'), ("d", "t", '{"\\udc00":1}')]
    rows = [(1, k, "assistant", None, [c], None) for k, c in enumerate(calls)]
    rows += [(1, 9, "tool", "done", None, c[0]) for c in calls]
    got = chat_tools.link_tools(prepare(spark).createDataFrame(rows, CALL), {"t": {"type": "object"}}).where("kind = 1")
    status = {r.call_id: r.status for r in got.collect()}
    assert status["c"] == "ok" and status["a"] == status["d"] == "arguments hold half a surrogate pair"
    assert status["b"] == "arguments are nested too deeply"


@pytest.mark.parametrize("bound", [10, 10**6])
def test_long_chains_and_cycles(spark, monkeypatch, bound):
    """20,000 calls, each on the one before, and a cycle with a follower: by doubling as in a task."""
    monkeypatch.setattr(chat_tools, "TASK_EDGES", bound)
    n = 20_000
    ref = lambda *ids: json.dumps({"r": [{"$ref": i} for i in ids]})
    calls = [(f"q{k}", "t", ref(f"q{k - 1}") if k else "{}") for k in range(n)]
    calls += [("x", "t", ref("y")), ("y", "t", ref("z")), ("z", "t", ref("x", "q5")), ("w", "t", ref("z", "q1"))]
    rows = [(1, k, "assistant", None, [c], None) for k, c in enumerate(calls)]
    out = chat_tools.link_tools(prepare(spark).createDataFrame(rows, CALL), {"t": {"type": "object"}})
    level = {r.call_id: (r.level, r.status) for r in out.where("kind = 1").collect()}
    assert all(level[f"q{k}"][0] == k for k in range(n))
    assert all(level[c] == (None, "cycle") for c in "xyzw")
