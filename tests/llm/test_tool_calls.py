"""Schemas of arguments keyword by keyword, and the linking of calls and results by force."""

import json
import random

import pytest

from kerbside.llm import chat_format
from kerbside.llm.schemas import check_schema, conforms


@pytest.mark.parametrize(
    ("schema", "good", "bad"),
    [
        ({"type": "integer", "maximum": 3, "minimum": 1}, [1, 3], [0, 4, 2.5, True, "2"]),
        ({"type": "number", "exclusiveMinimum": 0, "exclusiveMaximum": 1}, [0.5], [0, 1, -1]),
        ({"multipleOf": 0.1}, [0.3, 7, "x"], [0.35]),
        ({"type": "string", "minLength": 9, "pattern": "x"}, ["12345678x"], ["2020", "123456789", 5]),
        ({"maxLength": 2}, ["ab", "é𝄞", 12345], ["abc"]),
        ({"pattern": "^a+$"}, ["aa", 3], ["ab", ""]),
        ({"oneOf": [{"type": "string"}]}, ["s"], [{}, 1]),
        ({"oneOf": [{"minimum": 2}, {"maximum": 5}]}, [1, 6], [3]),
        ({"anyOf": [{"type": "string"}, {"type": "null"}]}, ["s", None], [1]),
        ({"allOf": [{"minimum": 2}, {"maximum": 5}]}, [3], [1, 6]),
        ({"not": {"type": "string"}}, [1], ["s"]),
        ({"enum": [1, "a", {"k": [1]}]}, [1, "a", {"k": [1]}], [2, "b", {"k": [2]}]),
        ({"const": None}, [None], [0, ""]),
        ({"type": ["integer", "null"]}, [1, None], ["1", False]),
        ({"items": {"type": "integer"}, "minItems": 1, "maxItems": 2, "uniqueItems": True}, [[1], [1, 2], "x"], [[], [1, 2, 3], [1, 1], ["a"]]),
        ({"properties": {"a": {"minimum": 1}}, "required": ["a"], "additionalProperties": False}, [{"a": 1}], [{}, {"a": 0}, {"a": 1, "b": 2}]),
        ({"additionalProperties": {"type": "string"}, "minProperties": 1, "maxProperties": 1}, [{"x": "y"}], [{}, {"x": 1}, {"x": "y", "z": "y"}]),
        ({"$ref": "#/$defs/a~1b", "$defs": {"a/b": {"type": "integer"}}}, [1], ["1"]),
        ({"type": "object", "properties": {"next": {"$ref": "#"}}, "additionalProperties": False}, [{"next": {"next": {}}}], [{"next": {"other": {}}}]),
        ({"properties": {"a": True, "b": False}, "title": "t", "description": "d"}, [{"a": 1}], [{"b": 1}]),
        (True, [1], []),
        (False, [], [1]),
    ],
)
def test_keywords(schema, good, bad):
    check_schema(schema)
    assert all(conforms(v, schema, chat_format.canonical) for v in good)
    assert not any(conforms(v, schema, chat_format.canonical) for v in bad)


@pytest.mark.parametrize(
    "schema",
    [
        {"maxmum": 3}, {"properties": {"a": {"dependentRequired": {}}}}, {"type": "text"}, {"pattern": "("}, {"minLength": "3"}, {"multipleOf": 0}, {"$ref": "#/nothing"},
        {"$ref": "http://elsewhere"}, {"$ref": "#"}, {"anyOf": [{"$ref": "#/$defs/a"}], "$defs": {"a": {"allOf": [{"$ref": "#"}]}}}, {"items": 3}, {"minimum": True},
    ],
)
def test_schemas_that_would_not_be_applied_are_refused(spark, schema):
    messages = spark.createDataFrame([(1, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    with pytest.raises(ValueError):
        chat_format.link_tool_calls(messages, {"t": {"type": "object", "properties": {"a": schema}, "$defs": {}}} if "$ref" not in schema and "anyOf" not in schema else {"t": schema})


def conversations(seed):
    """Calls and results with few identifiers, so that they repeat, miss each other, come too early and need each other in circles."""
    draw, rows = random.Random(seed), []
    for conv in (0, 1, 2, None):
        for turn in range(25):
            kind = draw.random()
            if kind < 0.45:
                calls = [
                    {"id": draw.choice(["a", "b", "c", "d", "e", "f", 7]), "name": draw.choice(["search", "search", "nothing"]), "arguments": draw.choice([{"query": "q"}, '{"query": "q"}', {"limit": 3}, "[]"]), "depends_on": draw.sample(["a", "b", "c", "d", "x"], draw.choice([0, 0, 1, 2]))}
                    for _ in range(draw.choice([1, 2, 3]))
                ]
                rows.append((conv, turn, "assistant", json.dumps({"content": "c", "tool_calls": calls})))
            elif kind < 0.85:
                rows.append((conv, turn, "tool", json.dumps({"tool_call_id": draw.choice(["a", "b", "c", "d", "e", "f", "g", None]), "content": turn})))
            else:
                rows.append((conv, turn, draw.choice(["user", "tool", None]), draw.choice(["plain", "", None, "{"])))
    return rows


def by_force(rows):
    """(conv, turn, part, kind, status, level, linked turn) of every event, one conversation at a time."""
    out = []
    for conv in {r[0] for r in rows}:
        events = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            events += [(turn, e["part"], e["kind"], e["call_id"], e["depends"], e["status"]) for e in chat_format.events_of(role, text, chat_format.SCHEMAS)]
        first = {}
        for e in sorted((e for e in events if e[3] is not None), key=lambda e: (e[0], e[1])):
            first.setdefault((e[2], e[3]), e)
        level, calls = {}, {k: e for (kind, k), e in first.items() if kind == "call"}
        for _ in range(len(calls)):
            for k, e in calls.items():
                needs = [d for d in e[4] if d in calls]
                if k not in level and all(d in level for d in needs):
                    level[k] = 1 + max((level[d] for d in needs), default=-1)
        for turn, part, kind, k, _, status in events:
            if k is None:
                out.append((conv, turn, part, kind, status, None, None))
                continue
            call, result = first.get(("call", k)), first.get(("result", k))
            if first[kind, k][:2] != (turn, part):
                status = "duplicate"
            elif status == "ok":
                if kind == "call":
                    status = "cycle" if k not in level else "no_result" if not result else "too_early" if result[0] <= turn else "ok"
                else:
                    status = "no_call" if not call else "too_early" if turn <= call[0] else "ok"
            other = result if kind == "call" else call
            out.append((conv, turn, part, kind, status, level.get(k) if kind == "call" else None, other[0] if other else None))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_linking_by_force(spark, seed):
    rows = conversations(seed)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    found = [tuple(r[c] for c in ("conv_id", "turn", "part", "kind", "status", "level", "linked_turn")) for r in chat_format.link_tool_calls(df).collect()]
    want = by_force(rows)
    assert sorted(found, key=str) == sorted(want, key=str)
    assert {w[4] for w in want} >= {"ok", "duplicate", "no_result", "no_call", "too_early", "unknown_tool", "invalid_arguments", "no_identifier"}
