"""Linking, order, validation and canonical JSON of tool calls."""

import json
import random

from cohortlake.llm import tool_calls
from cohortlake.llm.common import Scratch

SCHEMA = {"type": "object", "required": ["q"], "additionalProperties": False,
          "properties": {"q": {"type": "string"}, "n": {"type": "integer", "minimum": 1}, "tags": {"type": "array", "items": {"type": "string", "enum": ["a", "b"]}}}}


def call(*calls):
    return json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a, "after": w} for i, n, a, w in calls]})


def run(spark, messages):
    calls, results = tool_calls.parse(spark.createDataFrame(messages, "conv_id long, turn long, role string, text string"))
    schemas = spark.createDataFrame([("find", json.dumps(SCHEMA))], "name string, schema string")
    return tool_calls.link(calls, results, schemas, Scratch(spark, "test")).collect()


def test_statuses_order_and_validation(spark):
    messages = [
        (1, 0, "tool", json.dumps({"tool_call_id": "c1", "content": "too early"})),
        (1, 1, "assistant", call(("c3", "find", '{"n": 2.0, "q": "é"}', ["c1", "c2"]), ("c1", "find", '{"q":"x","n":0}', None), ("c2", "other", "{}", ["c1", "nowhere"]))),
        (1, 2, "tool", json.dumps({"tool_call_id": "c1", "content": '{"b":1,"a":[1.0,null]}'})),
        (1, 3, "tool", json.dumps({"tool_call_id": "c1", "content": "again"})),
        (1, 4, "assistant", call(("c1", "find", '{"tags": ["a", "z"], "x": 1}', None), (None, "find", "not json", None))),
        (1, 5, "tool", json.dumps({"tool_call_id": "zz", "content": None})),
        (2, 1, "assistant", call(("c1", "find", '{"q":"x"}', ["c2"]), ("c2", "find", '{"q":"x"}', ["c1"]), ("c4", "find", '{"q":"x"}', ["c2"]))),
        (3, 1, "user", None), (3, 2, "assistant", "plain text"), (3, 3, "tool", ""), (None, None, None, None),
    ]
    out = run(spark, messages)
    calls = {(r.conversation, r.turn, r.call_id): (r.status, r.level, r.missing, r.errors) for r in out if r.kind == "call"}
    assert calls == {
        (1, 1, "c1"): ("answered", 0, 0, ["$.n:minimum"]), (1, 1, "c2"): ("unanswered", 1, 1, None), (1, 1, "c3"): ("unanswered", 2, 0, []),
        (1, 4, "c1"): ("repeated_call", 0, 0, ["$.q:required", "$.x:additionalProperties", "$.tags[1]:enum"]), (1, 4, None): ("no_id", 0, 0, ["$:json"]),
        (2, 1, "c1"): ("unanswered", None, 0, []), (2, 1, "c2"): ("unanswered", None, 0, []), (2, 1, "c4"): ("unanswered", None, 0, []),
    }
    results = {(r.turn, r.call_id): r.status for r in out if r.kind == "result" and r.conversation == 1}
    assert results == {(0, "c1"): "early_result", (2, "c1"): "answer", (3, "c1"): "repeated_result", (5, "zz"): "orphan_result"}
    made = {(r.turn, r.kind, r.call_id): r.canonical for r in out}
    assert made[1, "call", "c3"] == '{"n":2,"q":"é"}' and made[2, "result", "c1"] == '{"a":[1,null],"b":1}' and made[3, "result", "c1"] is None


def test_levels_of_random_graphs(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for conversation in range(5):
        needs = {i: rng.sample(range(i), rng.randint(0, min(i, 3))) for i in range(12)}
        for i, parents in needs.items():
            want[conversation, f"k{i}"] = 1 + max((want[conversation, f"k{p}"] for p in parents), default=-1)
        order = list(needs)
        rng.shuffle(order)
        rows.append((conversation, 0, "assistant", call(*[(f"k{i}", "other", "{}", [f"k{p}" for p in needs[i]]) for i in order])))
    assert {(r.conversation, r.call_id): r.level for r in run(spark, rows)} == want


def test_calls_without_id_stand_behind_what_they_need(spark):
    out = run(spark, [
        (1, 0, "assistant", call(("a", "other", "{}", None), ("b", "other", "{}", ["a"]), (None, "other", "{}", ["b", "nowhere"]), (None, "other", "{}", None), (None, "other", "{}", ["a"]))),
        (1, 1, "assistant", call(("x", "other", "{}", ["y"]), ("y", "other", "{}", ["x"]), (None, "other", "{}", ["x", "a"]))),
    ])
    got = {(r.turn, r.place): (r.status, r.level, r.missing) for r in out}
    assert got[0, 1] == ("unanswered", 1, 0)
    assert (got[0, 2], got[0, 3], got[0, 4]) == (("no_id", 2, 1), ("no_id", 0, 0), ("no_id", 1, 0))
    assert got[1, 2] == ("no_id", None, 0)


def test_no_messages(spark):
    assert run(spark, []) == []


def test_the_query_links_tool_messages_and_reads_the_other_turns_as_calls(spark, tmp_path):
    messages = [
        (1, 0, "user", "words"), (1, 1, "assistant", "an answer"), (1, 2, "assistant", call(("turn-0", "reply", '{"words": 1}', None), ("b", "reply", "no json", ["turn-0"]))),
        (1, 3, "tool", json.dumps({"tool_call_id": "b", "content": '{"z":1,"a":2.0}'})), (1, 4, "tool", json.dumps({"tool_call_id": "c", "content": None})),
        (2, 0, "assistant", '{"tool_calls": []}'), (None, None, None, None),
    ]
    spark.createDataFrame(messages, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    out = tool_calls.op2_tool_calls(spark, str(tmp_path)).collect()
    got = {(r.conv_id, r.turn, r.kind, r.call_id): (r.status, r.level, r.errors, r.canonical) for r in out}
    assert len(out) == len(got) == 8
    assert got[1, 0, "call", "turn-0"] == ("answered", 0, "$.words:minimum", '{"text":"words","words":1}')
    assert got[1, 1, "result", "turn-0"][0] == "answer" and got[2, 0, "result", "turn--1"][0] == "orphan_result"
    assert got[1, 2, "call", "turn-0"][:2] == ("unanswered", 0) and "$.text:required" in got[1, 2, "call", "turn-0"][2]
    assert got[1, 2, "call", "b"] == ("answered", 1, "$:json", None)
    assert got[1, 3, "result", "b"] == ("answer", None, None, '{"a":2,"z":1}') and got[1, 4, "result", "c"][0] == "orphan_result"


def test_a_long_chain_takes_no_round_per_call(spark):
    import time

    n = 1000
    chain = call(*[(f"k{i}", "other", "{}", [f"k{i - 1}"] if i else None) for i in range(n)])
    began = time.time()
    out = run(spark, [(1, 0, "assistant", chain)])
    assert time.time() - began < 60
    assert {r.call_id: r.level for r in out} == {f"k{i}": i for i in range(n)}


def test_large_conversations_are_ordered_in_rounds_with_the_same_levels(spark, monkeypatch):
    rng = random.Random(8)
    rows = []
    for conversation in range(4):
        made = [(f"k{i}", "other", "{}", [f"k{rng.randrange(10)}" for _ in range(rng.randint(0, 2))]) for i in range(10)]  # cycles too
        rows.append((conversation, 0, "assistant", call(*made)))
    want = {(r.conversation, r.call_id): (r.level, r.missing) for r in run(spark, rows)}
    assert None in {level for level, _ in want.values()}
    for limit in (0, 8):  # all in rounds, and some
        monkeypatch.setattr(tool_calls, "EDGES_IN_PLACE", limit)
        assert {(r.conversation, r.call_id): (r.level, r.missing) for r in run(spark, rows)} == want


def test_unparsable_tool_messages_make_no_records(spark):
    texts = ["not json", "", None, "[]", "{}", '{"tool_call_id": null, "content": null}']
    assert run(spark, [(1, i, "tool", t) for i, t in enumerate(texts)]) == []
    kept = run(spark, [(1, 0, "tool", '{"content": "x"}'), (None, 1, "tool", '{"tool_call_id": "a", "content": "x"}')])
    assert sorted(r.status for r in kept) == ["no_id", "orphan_result"]
