import json

import pytest
from hypothesis import given as holds_for
from hypothesis import settings
from hypothesis import strategies as st

from driftmon.llm import chat
from driftmon.llm.queries import TOOLS, op10_chat, tool_messages

MESSAGE = "conv_id long, turn long, role string, text string"


def call(key, name="search", after=(), **arguments):
    return {"id": key, "name": name, "arguments": arguments, "after": list(after)}


def calls(*these):
    return json.dumps({"tool_calls": list(these)})


def result(key, content="ok"):
    return json.dumps({"tool_call_id": key, "content": content})


def lines(frame):
    order = ("conv_id", "turn_at", "stage", "place", "part", "json")
    return sorted(frame.collect(), key=lambda r: tuple((r[c] is not None, r[c]) for c in order))


VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**60), 2**60) | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=8),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=5), inner, max_size=3),
    max_leaves=8,
)


@settings(max_examples=200, deadline=None)
@holds_for(VALUES)
def test_canonical_json_is_a_round_trip_and_stable(value):
    line = chat.canonical(value)
    assert json.loads(line) == value
    assert chat.canonical(json.loads(line)) == line


def test_canonical_json():
    assert chat.canonical({"b": 1.0, "a": [True, None, 1.5], "é": "\n"}) == '{"a":[true,null,1.5],"b":1,"é":"\\n"}'


@pytest.mark.parametrize(
    "value, faults",
    [
        ({"query": "x", "limit": 3}, []),
        ({"query": "x", "limit": 3.0}, []),
        ({"query": "x"}, ["$.limit: missing"]),
        ({"query": 1, "limit": 200, "more": 0}, ["$.more: unknown", "$.limit: too large", "$.query: not of type string"]),
        ({"query": "x", "limit": True}, ["$.limit: not of type integer"]),
        ([], ["$: not of type object"]),
    ],
)
def test_arguments_against_a_schema(value, faults):
    assert chat.faults(value, TOOLS["search"]) == faults


def test_calls_are_linked_ordered_and_checked(spark):
    rows = [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", calls(call("a", query="x", limit=1), call("b", after=["c"], query="y", limit=2), call("c", query="z", limit="3"))),
        (1, 2, "tool", result("c")),
        (1, 3, "tool", result("a", "first")),
        (1, 4, "tool", result("a", "again")),
        (1, 5, "assistant", calls(call("d", "translate", after=["e"], text="t", to="xx"))),
        (1, 6, "tool", result("lost")),
        (1, 9, "assistant", calls(call("e", "nothing"))),
        (2, 0, "assistant", calls(call("a", after=["b"], query="q", limit=1), call("b", after=["a", "zz"], query="q", limit=1))),
    ]
    got = lines(chat.format_chats(spark.createDataFrame(rows, MESSAGE), TOOLS))
    view = [(r.conv_id, r.turn_at, r.kind, r.call_id, r.copies, r.problems) for r in got]
    assert view == [
        (1, 0, "message", None, 1, []),
        (1, 1, "call", "a", 1, []),
        (1, 1, "result", "a", 2, ["repeated"]),
        (1, 1, "call", "c", 1, ["$.limit: not of type integer"]),
        (1, 1, "result", "c", 1, []),
        (1, 1, "call", "b", 1, ["no result"]),
        (1, 6, "result", "lost", 1, ["no call"]),
        (1, 9, "call", "e", 1, ["no result", "unknown tool"]),
        (1, 9, "call", "d", 1, ["no result", "$.to: not one of the values"]),
        (2, 0, "call", "a", 1, ["no result", "circular"]),
        (2, 0, "call", "b", 1, ["no result", "circular"]),
    ]
    assert got[1].json == '{"arguments":{"limit":1,"query":"x"},"id":"a","name":"search"}'
    assert got[2].json == '{"content":"first","tool_call_id":"a"}'
    assert got[0].json == '{"content":"hi","role":"user"}'


def test_repeated_identifiers_keep_every_call_and_result(spark):
    rows = [
        (1, 1, "assistant", calls(call("0", query="a", limit=1), call("1", after=["0"], query="b", limit=1))),
        (1, 2, "tool", result("0", "r0")),
        (1, 3, "tool", result("1", "r1")),
        (1, 5, "assistant", calls(call("0", query="c", limit=1), call("1", after=["0"], query="d", limit=1))),
        (1, 6, "tool", result("0", "s0")),
        (1, 7, "tool", result("0", "over")),
        (1, 8, "tool", result("gone", "x")),
        (1, 9, "tool", result("gone", "y")),
        (2, 1, "assistant", calls(call(None, query="p", limit=1), call(None, query="q", limit=1))),
        (2, 3, "assistant", calls(call(None, query="r", limit=1))),
        (None, 1, "assistant", calls(call(None, query="s", limit=1))),
        (None, 1, "assistant", calls(call(None, query="t", limit=1))),
    ]
    got = lines(chat.format_chats(spark.createDataFrame(rows, MESSAGE), TOOLS))
    view = [
        (r.conv_id, r.turn_at, r.stage, r.call_id, json.loads(r.json).get("content") or json.loads(r.json)["arguments"]["query"], r.copies, r.problems, r.repeats)
        for r in got
    ]
    over = ['{"content":"over","tool_call_id":"0"}']
    assert view == [
        (None, 1, 0, None, "s", 2, ["no result", "repeated"], []),
        (None, 1, 0, None, "t", 2, ["no result", "repeated"], []),
        (1, 1, 0, "0", "a", 2, ["repeated"], []),
        (1, 1, 0, "0", "r0", 3, ["repeated"], []),
        (1, 1, 1, "1", "b", 2, ["repeated"], []),
        (1, 1, 1, "1", "r1", 1, [], []),
        (1, 5, 0, "0", "c", 2, ["repeated"], []),
        (1, 5, 0, "0", "s0", 3, ["repeated"], over),
        (1, 5, 1, "1", "d", 2, ["no result", "repeated"], []),
        (1, 8, 0, "gone", "x", 2, ["no call", "repeated"], []),
        (1, 9, 0, "gone", "y", 2, ["no call", "repeated"], []),
        (2, 1, 0, None, "p", 1, ["no result"], []),
        (2, 1, 0, None, "q", 1, ["no result"], []),
        (2, 3, 0, None, "r", 1, ["no result"], []),
    ]


def test_what_is_said_beside_calls_and_results_stays(spark):
    told = {"tool_calls": [call("a", query="x", limit=1)]}
    rows = [
        (1, 1, "assistant", json.dumps(told | {"content": "Let me look."})),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "ok", "cost": 3})),
        (1, 3, "assistant", json.dumps(told | {"content": None})),
        (1, 4, "assistant", json.dumps(told | {"content": "", "why": "b"})),
    ]
    got = chat.format_chats(spark.createDataFrame(rows, MESSAGE), TOOLS).where("kind = 'message'")
    assert [(r.turn_at, json.loads(r.json)) for r in lines(got)] == [
        (1, {"role": "assistant", "content": "Let me look."}),
        (2, {"role": "tool", "content": '{"cost":3}'}),
        (4, {"role": "assistant", "content": '{"content":"","why":"b"}'}),
    ]


def test_odd_messages(spark):
    rows = [
        (None, None, None, None),
        (None, 0, "assistant", calls(call("a", query="x", limit=1))),
        (None, 1, "tool", result("a")),
        (3, None, "assistant", calls(call(None, query="x", limit=1))),
        (3, 0, "assistant", '{"tool_calls": [{"id": '),
        (3, 1, "tool", "plain"),
        (3, 2, "assistant", '{"tool_calls": []}'),
        (3, 3, "user", "x" * 200_000),
        (3, 3, "user", "same"),
        (3, 3, "user", "same"),
        (3, 4, "assistant", '{"tool_calls": [{"id": "j", "name": "search", "arguments": "{\\"limit\\": 1, \\"query\\": \\"q\\"}"}]}'),
        (3, 5, "assistant", '{"tool_calls": [{"id": "k", "name": "search", "arguments": "nope"}]}'),
    ]
    frame = spark.createDataFrame(rows, MESSAGE).selectExpr("*", "'x' as call_id", "1 as stage", "2 as json", "3 as wait")
    got = lines(chat.format_chats(frame, TOOLS))
    assert sorted(r.kind for r in got).count("message") == 7
    by = {(r.conv_id, r.call_id, r.kind): r for r in got if r.kind != "message"}
    assert len(by) == 5
    assert by[None, "a", "result"].problems == []
    assert by[3, None, "call"].problems == ["no result"]
    assert by[3, "j", "call"].json == '{"arguments":{"limit":1,"query":"q"},"id":"j","name":"search"}'
    assert by[3, "k", "call"].problems == ["no result", "$: not JSON"]
    assert chat.format_chats(frame.where("false"), TOOLS).count() == 0


def test_query_equals_brute_force(spark, sf_dir, given):
    """Every message, call and result of the derived conversations, linked in plain Python."""
    told = given("conversations", "conv_id, turn, role, text")
    want = set()
    users = {(c, t): x for c, t, r, x in told if r == "user"}
    answers = {(c, t): x for c, t, r, x in told if r == "assistant"}
    for c, t, r, x in told:
        want.add((c, t, -1, 0, 0, "message", None, chat.canonical({"role": r, "content": x}), ()))
    for row in tool_messages(spark.read.parquet(f"{sf_dir}/conversations.parquet")).where("role = 'assistant' and text like '{%'").collect():
        (one,) = json.loads(row.text)["tool_calls"]
        line, faults = chat.checked_call(one["id"], one["name"], json.dumps(one["arguments"]) if not isinstance(one["arguments"], str) else one["arguments"], TOOLS)
        missing = [] if (row.conv_id, row.turn + 1) in answers else ["no result"]
        want.add((row.conv_id, row.turn, 0, 0, 0, "call", one["id"], line, (*missing, *faults)))
    for (c, t), x in answers.items():
        key, linked = f"{c}-{t - 1}", (c, t - 1) in users
        line = chat.canonical({"tool_call_id": key, "content": x})
        want.add((c, t - 1 if linked else t, 0, 0, 1, "result", key, line, () if linked else ("no call",)))
    got = {
        (r.conv_id, r.turn_at, r.stage, r.place, r.part, r.kind, r.call_id, r.json, tuple(r.problems))
        for r in op10_chat(spark, sf_dir).collect()
    }
    assert got == want


def test_half_surrogates_are_escaped_and_said(spark):
    half = '{"query":"\\ud800"}'
    rows = [
        (1, 0, "assistant", '{"content":"half \\ud83d","tool_calls":[{"id":"a","name":"search","arguments":%s}]}' % json.dumps(half)),
        (1, 1, "tool", '{"tool_call_id":"a","content":"x","more":"\\udc00"}'),
        (1, 2, "assistant", '{"tool_calls":[{"id":"b","name":"search","arguments":"{\\"\\\\ud801\\":1}"}]}'),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    schema = {"type": "object", "properties": {"query": {"type": "string"}}, "additionalProperties": False}
    got = chat.format_chats(frame, {"search": schema}).collect()
    lines = {(r["kind"], r["turn_at"]): r["json"] for r in got}
    assert json.loads(lines["call", 0])["arguments"] == {"query": "\ud800"}
    assert json.loads(lines["message", 0])["content"] == "half \ud83d"
    assert json.loads(json.loads(lines["message", 1])["content"]) == {"more": "\udc00"}
    (problems,) = (r["problems"] for r in got if r["call_id"] == "b" and r["kind"] == "call")
    assert any(p.endswith("unknown") for p in problems)
    assert ("message", 2) not in lines


def test_numbers_are_shortest():
    want = {1e-7: "1e-7", 1e-6: "0.000001", 1.5e300: "1.5e+300", 1e16: "1e+16", 1e21: "1e+21", -0.25: "-0.25",
            123456.789: "123456.789", 5e-324: "5e-324", 2.0: "2"}
    for value, line in want.items():
        assert chat.canonical(value) == line
        assert json.loads(line) == value


def test_schemas():
    one = {"type": ["integer", "null"]}
    assert chat.faults(None, one) == chat.faults(3.0, one) == []
    assert chat.faults("3", one) == ["$: not of type integer or null"]
    assert chat.faults(True, {"enum": [1]}) and not chat.faults(1.0, {"enum": [1]})
    for schema in ({"minLength": 1}, {"properties": {"a": {"pattern": "x"}}}, {"type": "text"}, {"items": {"anyOf": []}}, {"type": ["integer", "none"]}):
        with pytest.raises(ValueError):
            chat.refuse_unknown(schema)
