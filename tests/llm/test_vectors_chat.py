"""Exact search and tool-call linking against plain Python."""

import json
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import chat, queries, vectors

SHAPE = "vec_id long, embedding array<float>, score long, rank int, id long, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 1, 1, "x") for i, v in rows], SHAPE)


def brute(rows, asked, k):
    def whole(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and whole(v)]
    smallest = {}
    for i, v in rows:
        if i in asked and whole(v):
            smallest[i] = min(smallest.get(i, v), v)
    out = []
    for q, v in smallest.items():
        a = [math.floor(256 * x) for x in v]
        score = lambda b: max(min(sum(x * y for x, y in zip(a, b, strict=True)), 2**63 - 1), -(2**63))  # noqa: E731, B023
        scored = sorted((-score(b), i) for i, b in usable if i != q and len(b) == len(a))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("tile", [2, vectors.TILE])
def test_top_k(spark, tile):
    import random

    rng = random.Random(1)
    rows = [(i, [float(round(rng.uniform(-1, 1), 3)) for _ in range(4)]) for i in range(60)]
    rows = [(i, [struct_float(x) for x in v]) for i, v in rows]
    rows += [(100 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(40)]  # copies: ties by id
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan")] * 4), (203, [float("inf"), 0.0, 0.0, 0.0]), (204, [1.0, 2.0]), (205, []), (206, []), (None, [1.0] * 4)]
    rows += [(10, rows[10][1]), (5, [0.25, 0.0, 0.0, 0.0])]
    asked = {0, 5, 10, 20, 100, 201, 204, 205}
    source = frame(spark, rows).repartition(3)
    found = vectors.top_k(source, source.filter(source.vec_id.isin(*asked)), k=5, tile=tile).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, asked, 5)


def struct_float(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


def test_large_components_and_empty_tables(spark):
    rows = [(i, [struct_float(x) for x in v]) for i, v in [(0, [3e18, 1.0]), (1, [3e18, 5.0]), (2, [-3e18, 1.0]), (3, [1e5, 2.0])]]
    source = frame(spark, rows)
    assert sorted(tuple(r) for r in vectors.top_k(source, source, k=2).collect()) == brute(rows, {0, 1, 2, 3}, 2)
    nothing = frame(spark, [])
    assert vectors.top_k(nothing, nothing).collect() == [] == vectors.top_k(source, nothing).collect()


JSON = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=5), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=3), x, max_size=3), max_leaves=8)


@settings(max_examples=200, deadline=None)
@given(JSON)
def test_canonical(value):
    text = chat.canonical(value)
    assert json.loads(text) == value and chat.canonical(json.loads(text)) == text


def test_violations():
    schema = queries.ASK["ask"]
    assert chat.violation({"text": "a", "words": 1}, schema) is None
    for value, error in [([], "$: type"), ({"text": "a"}, "$.words: required"), ({"text": "", "words": 1}, "$.text: length"), ({"text": "a", "words": 1.5}, "$.words: type"), ({"text": "a", "words": 0}, "$.words: minimum"), ({"text": "a", "words": 1, "more": 1}, "$.more: unknown")]:
        assert chat.violation(value, schema) == error
    rest = {"type": ["array", "null"], "items": {"enum": [1, "a"]}, "maxItems": 2}
    assert [chat.violation(v, rest) for v in (None, [1, "a"], [2], [1, 1, 1], "x")] == [None, None, "$[0]: enum", "$: items", "$: type"]
    assert chat.violation("abc", {"pattern": "^b"}) == "$: pattern" and chat.violation(True, {"type": "integer"}) == "$: type" and chat.violation(1, {"const": 1.0}) is None


def call(*calls):
    return json.dumps({"tool_calls": [{"id": i, "name": "f", "arguments": {"x": 1}, "after": list(a)} for i, *a in calls]})


def result(i):
    return json.dumps({"tool_call_id": i, "content": "r" + i})


def test_links_order_and_marks(spark):
    rows = [
        (1, 0, "user", "hello"), (1, 1, "assistant", call(["a"], ["b", "a"])), (1, 2, "tool", result("b")), (1, 3, "tool", result("a")),
        (1, 4, "tool", result("a")), (1, 5, "tool", result("ghost")), (1, 6, "assistant", call(["a"], ["open"])),
        (2, 0, "tool", result("late")), (2, 1, "assistant", call(["late"])), (2, 2, "assistant", call(["x", "y"], ["y", "x"])),
        (3, 0, "assistant", '{"tool_calls": [{"name": "g"}, 7, {"id": "q", "name": "f", "arguments": "{\\"x\\": 2}"}]}'), (3, 1, "assistant", "{not json"), (3, 2, "user", None),
        (None, 0, "tool", result("a")), (4, None, "assistant", call(["n"])), (5, 0, "assistant", '{"tool_calls": []}'), (5, 1, "tool", "plain"), (5, 2, None, ""),
        (6, 0, "assistant", json.dumps({"content": "\ud800", "tool_calls": []})),
    ]
    messages = spark.createDataFrame([(*r, 0, "j") for r in rows], "conv_id long, turn long, role string, text string, part int, json string")
    schemas = {"f": {"type": "object", "properties": {"x": {"type": "integer"}}, "required": ["x"]}}
    found = chat.format_calls(messages, schemas).collect()
    by = {(r.conv_id, r.turn, r.part): r for r in found}
    assert len(found) == len(rows) + 1 + 1 + 1 + 2 and all(json.loads(r.json) is not None for r in found)

    def order(conv):
        return [(r.turn, r.part) for r in sorted((r for r in found if r.conv_id == conv), key=lambda r: (r.place_turn, r.place_part, r.depth, r.turn, r.part))]

    assert order(1) == [(0, 0), (1, 0), (3, 0), (1, 1), (2, 0), (4, 0), (5, 0), (6, 0), (6, 1)]
    assert order(2)[:2] == [(1, 0), (0, 0)]
    assert by[1, 1, 0].linked and by[1, 1, 1].linked and by[1, 2, 0].linked and by[1, 3, 0].linked and not by[1, 4, 0].linked
    marks = {k: r.error for k, r in by.items() if r.error}
    assert marks[1, 4, 0] == "repeated" and marks[1, 5, 0] == "unlinked" and marks[1, 6, 0] == "repeated" and marks[1, 6, 1] == "unlinked"
    assert marks[2, 2, 0] == "unlinked" and order(2) == [(1, 0), (0, 0), (2, 0), (2, 1)]
    assert marks[3, 0, 0].startswith("no identifier") and marks[3, 0, 2] == "unlinked" and by[3, 0, 2].valid and not by[3, 0, 0].valid
    assert by[3, 2, 0].json == '{"content":"","role":"user"}' and by[None, 0, 0].error == "unlinked" and (1, 0, 0) not in marks
    empty = messages.filter("conv_id = -1")
    assert chat.format_calls(empty, schemas).collect() == []


def test_long_chains_and_cycles(spark):
    """A reversed chain is turned round, a long chain in order takes no rounds, cycles keep their place."""
    n, rows = 6, []
    for i in range(n):  # call i needs call i + 1, which comes later
        rows.append((1, i, "assistant", call([f"c{i}", f"c{i + 1}"] if i < n - 1 else [f"c{i}"])))
    for i in range(300):
        rows += [(2, 2 * i, "assistant", call([f"d{i}", f"d{i - 1}"])), (2, 2 * i + 1, "tool", result(f"d{i}"))]
    rows += [(3, 0, "assistant", call(["p", "q"], ["q", "p"], ["behind", "p"], ["free"]))]
    rows += [(3, 1 + i, "tool", result(x)) for i, x in enumerate(["p", "q", "behind", "free"])]
    found = chat.format_calls(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), {"f": {}}).collect()

    def order(conv):
        return [(r.kind, r.call_id) for r in sorted((r for r in found if r.conv_id == conv), key=lambda r: (r.place_turn, r.place_part, r.depth, r.turn, r.part))]

    assert order(1) == [("call", f"c{i}") for i in reversed(range(n))]
    assert order(2) == [(k, f"d{i}") for i in range(300) for k in ("call", "result")]
    assert {r.call_id for r in found if r.conv_id == 3 and r.error == "cyclic"} == {"p", "q", "behind"}
    assert order(3)[:4] == [("call", x) for x in ("p", "q", "behind", "free")]


def test_query_links_each_question_to_its_answer(spark):
    folder = "/root/testdata/sf0.001"
    turns = {(r.conv_id, r.turn): r for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()}
    found = queries.QUERIES["op5_chat_calls"](spark, folder).collect()
    assert len(found) == len(turns)
    for r in found:
        t = turns[r.conv_id, r.turn]
        value = json.loads(r.json)
        if t.role == "user":
            after = turns.get((t.conv_id, t.turn + 1))
            assert r.linked == (after is not None and after.role == "assistant") and value["arguments"]["text"] == t.text
            assert r.valid == (1 <= len(t.text.split()) <= 120) and r.depth % 2 == 0
        else:
            assert value["content"] == t.text
