"""Chat formatting: link tool calls to their results and serialise canonical JSON.

An assistant's message that is a JSON object with ``tool_calls`` makes calls, each with an ``id``, a ``name``, ``arguments`` (an
object, or its JSON text) and optionally ``depends_on``, a list of ids. A tool's message that is a JSON object with a
``tool_call_id`` is a result. Calls and results of a conversation are hash-joined by identifier. Calls are ordered
topologically: one whose dependencies all have levels is a level above them. Whole conversations are ordered in tasks of bounded
size; one with more dependencies than that is ordered by joins.

Every event is a row with its place (turn, level, part) rather than a part of one row a conversation, so that no task gathers a
conversation, however long.
"""

from __future__ import annotations

import json
import math
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_slices
from .durable import durable
from .schemas import Schema, check_schema, conforms


def _object(required: list[str], **properties: Schema) -> Schema:
    return {"type": "object", "properties": properties, "required": required, "additionalProperties": False}


#: Schemas of the arguments of the tools that are known by default; callers give their own.
SCHEMAS: dict[str, Schema] = {
    "search": _object(["query"], query={"type": "string"}, limit={"type": "integer"}),
    "fetch": _object(["url"], url={"type": "string"}, headers={"type": "object"}),
    "calculate": _object(["expression"], expression={"type": "string"}, precision={"type": "integer"}),
    "convert": _object(["value", "unit"], value={"type": "number"}, unit={"type": "string"}, exact={"type": "boolean"}),
    "store": _object(["key", "values"], key={"type": "string"}, values={"type": "array"}),
}
#: Dependencies whose calls one task orders; a conversation with more is ordered by joins.
LOCAL_NEEDS = 200_000


def parse(text: str | None) -> Any:
    """The JSON value of a text; None where it is not JSON, or holds numbers that JSON has not or that are beyond a double.

    Of a key that an object repeats the last value counts.
    """

    def refuse(name: str) -> None:
        raise ValueError(name)

    def finite(number: str) -> float:
        value = float(number)
        return value if math.isfinite(value) else refuse(number)

    try:
        value = json.loads(text or "", parse_constant=refuse, parse_float=finite)
        canonical(value)  # what is too deep to write is not read
        return value
    except (ValueError, RecursionError):
        return None


def canonical(value: Any) -> str:
    """JSON with sorted keys and no white space; lone surrogates, which UTF-8 has not, become U+FFFD."""
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return text.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


def validate(name: Any, arguments: Any, schemas: dict[str, Schema]) -> str:
    """``ok``, ``unknown_tool`` or ``invalid_arguments``."""
    if not isinstance(name, str) or name not in schemas:
        return "unknown_tool"
    try:
        return "ok" if isinstance(arguments, dict) and conforms(arguments, schemas[name], canonical) else "invalid_arguments"
    except RecursionError:  # too deep to be followed through a schema that refers to itself
        return "invalid_arguments"


def events_of(role: str | None, text: str | None, schemas: dict[str, Schema]) -> list[dict[str, Any]]:
    """A message's events: the message itself as part 0, or its result, and its calls from part 1 on."""

    def event(part: int, kind: str, call_id: str | None, depends: list[str], status: str, value: Any) -> dict[str, Any]:
        return {"part": part, "kind": kind, "call_id": call_id, "depends": depends, "status": status, "json": canonical(value)}

    value = parse(text) if text and text.lstrip()[:1] == "{" and role in ("assistant", "tool") else None
    if role == "tool":
        call_id = value.get("tool_call_id") if isinstance(value, dict) else None
        if not isinstance(call_id, str):
            return [event(0, "result", None, [], "no_identifier", {"content": text, "role": role})]
        return [event(0, "result", call_id, [], "ok", {"content": value.get("content"), "role": role, "tool_call_id": call_id})]
    calls = value.get("tool_calls") if isinstance(value, dict) else None
    if not isinstance(calls, list):
        return [event(0, "message", None, [], "ok", {"content": text, "role": role})]
    out = [event(0, "message", None, [], "ok", {"content": value.get("content"), "role": role})]
    for part, call in enumerate(calls, 1):
        call = call if isinstance(call, dict) else {}
        call_id, arguments = call.get("id"), call.get("arguments")
        arguments = parse(arguments) if isinstance(arguments, str) else arguments
        depends = sorted({d for d in call.get("depends_on") or [] if isinstance(d, str)}) if isinstance(call.get("depends_on") or [], list) else []
        status = validate(call.get("name"), arguments, schemas) if isinstance(call_id, str) else "no_identifier"
        out.append(event(part, "call", call_id if isinstance(call_id, str) else None, depends, status, {"arguments": arguments, "id": call_id, "name": call.get("name")}))
    return out


def ordered(nodes: list[Any], needs: list[tuple[Any, Any]]) -> dict[Any, int]:
    """The level of each node by (node, needed node) pairs: one above the highest that it needs; none on or behind a cycle."""
    above: dict[Any, list[Any]] = {}
    open_needs = dict.fromkeys(nodes, 0)
    for node, need in needs:
        above.setdefault(need, []).append(node)
        open_needs[node] += 1
    level = dict.fromkeys((n for n in nodes if not open_needs[n]), 0)
    ready = list(level)
    for done in ready:
        for node in above.get(done, ()):
            open_needs[node] -= 1
            if not open_needs[node]:  # the last of its needs, in breadth-first order, is the highest
                level[node] = level[done] + 1
                ready.append(node)
    return level


def _levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of calls; those on or behind a cycle have none. Unknown dependencies count as met.

    Conversations are dealt to tasks of about LOCAL_NEEDS dependencies each; one with more is ordered level by level, by joins.
    """
    known = calls.select("conv_id", "call_id")
    needs = calls.select("conv_id", "call_id", F.explode("depends").alias("need")).distinct()
    needs = durable(needs.join(known.toDF("c", "n"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("need") == F.col("n"))).drop("c", "n"))
    total = needs.count()
    if not total:
        return known.withColumn("level", F.lit(0))
    sizes = needs.groupBy("conv_id").agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > LOCAL_NEEDS).select(F.col("conv_id").alias("c"))
    conv = F.col("conv_id").eqNullSafe(F.col("c"))
    small = needs.join(large, conv, "left_anti")

    def order(pdf: pd.DataFrame) -> pd.DataFrame:
        pairs = [((c, a), (c, b)) for c, a, b in zip(pdf["conv"], pdf["call_id"], pdf["need"], strict=True)]
        found = ordered(list(dict.fromkeys(n for p in pairs for n in p)), pairs)
        return pd.DataFrame([(*node, k) for node, k in found.items()], columns=["conv", "call_id", "level"])

    deal = F.pmod(F.xxhash64("conv_id"), F.lit(total // LOCAL_NEEDS + 1))
    # As texts, ids keep their digits beside nulls in pandas.
    dealt = small.select(deal.alias("deal"), F.col("conv_id").cast("string").alias("conv"), "call_id", "need").groupBy("deal")
    levels = dealt.applyInPandas(order, "conv string, call_id string, level int").select(F.col("conv").cast("long").alias("conv_id"), "call_id", "level")
    bound = needs.select("conv_id", "call_id").union(needs.select("conv_id", "need")).distinct()
    free = known.join(bound.toDF("c", "n"), conv & (F.col("call_id") == F.col("n")), "left_anti").withColumn("level", F.lit(0))
    levels = levels.unionByName(free)
    if large.limit(1).count():
        levels = levels.unionByName(_levels_by_joins(bound.join(large, conv, "left_semi"), needs.join(large, conv, "left_semi")))
    return levels


def _levels_by_joins(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """The levels of conversations too large for a task, in as many rounds as there are levels; each round joins what waits only."""
    waiting = needs.select("conv_id", "call_id").distinct()
    calls, needs = durable(calls), durable(needs)
    level = 0
    new = durable(calls.join(waiting.toDF("c", "n"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("n")), "left_anti"))
    out = new.withColumn("level", F.lit(level))
    while new.limit(1).count():
        # A need that is met goes; a call without needs left is of the next level.
        met = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("need") == F.col("n"))
        left = durable(needs.join(new.toDF("c", "n"), met, "left_anti"))
        still = left.select("conv_id", "call_id").distinct().toDF("c", "n")
        tried = needs.join(new.toDF("c", "n"), met, "left_semi").select("conv_id", "call_id").distinct()
        new = durable(tried.join(still, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("n")), "left_anti"))
        needs, level = left, level + 1
        out = out.unionByName(new.withColumn("level", F.lit(level)))
    return out


def link_tool_calls(messages: DataFrame, schemas: dict[str, Schema] = SCHEMAS) -> DataFrame:
    """One row per message, call and result of (conv_id, turn, role, text) rows.

    Columns: conv_id, turn, part, kind (message, call, result), call_id, level (of calls), linked_turn (a call's result's turn,
    a result's call's), status and json. Of several calls with one identifier in a conversation the first by (turn, part) counts,
    likewise of results; later ones are ``duplicate``. Calls without a result are ``no_result``, results without a call ``no_call``,
    results of no later turn than their call's ``too_early``, calls on or behind a cycle ``cycle``; a call's arguments are judged
    first. Texts that are not the JSON looked for, null and empty ones included, are plain messages; null roles and conversations
    are kept as such. Repeated rows give repeated events, whose calls are duplicates. Texts of any length are read whole. JSON is
    strict: a text with a number beyond a double, or nested too deeply to write again, is not JSON. Other columns are not read.
    ``schemas`` has a JSON Schema of the arguments by tool; one with anything that would not be applied is refused.
    """
    for schema in schemas.values():
        check_schema(schema)
    fields = "part int, kind string, call_id string, depends array<string>, status string, json string"

    def kernel(cols: dict[str, list]) -> dict[str, list]:
        made = [events_of(r, t, schemas) for r, t in zip(cols["role"], cols["text"], strict=True)]
        return {"conv_id": cols["conv_id"], "turn": cols["turn"], "events": made}

    rows = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    parsed = map_slices(rows, kernel, f"conv_id long, turn long, events array<struct<{fields.replace(' ', ':').replace(',:', ',')}>>")
    events = parsed.select("conv_id", "turn", F.inline("events"))
    marked = durable(events.where("call_id is not null"))
    place = F.struct("turn", "part")
    firsts = durable(marked.groupBy("conv_id", "kind", "call_id").agg(F.min(F.struct("turn", "part", "depends")).alias("first")))
    calls = firsts.where("kind = 'call'").select("conv_id", "call_id", F.col("first.turn").alias("call_turn"), F.col("first.depends").alias("depends"), F.lit(True).alias("called"))
    results = firsts.where("kind = 'result'").select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.col("first.turn").alias("result_turn"), F.lit(True).alias("answered"))
    levels = _levels(calls.select("conv_id", "call_id", "depends")).toDF("lc", "li", "level")
    linked = calls.join(results, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("i")), "full")
    linked = linked.select(F.coalesce("conv_id", "c").alias("conv_id"), F.coalesce("call_id", "i").alias("call_id"), "call_turn", "result_turn", "called", "answered")
    linked = linked.join(levels, F.col("conv_id").eqNullSafe(F.col("lc")) & (F.col("call_id") == F.col("li")), "left").drop("lc", "li")
    own = firsts.select(F.col("conv_id").alias("fc"), F.col("kind").alias("fk"), F.col("call_id").alias("fi"), F.struct("first.turn", "first.part").alias("first"))
    found = marked.join(own, F.col("conv_id").eqNullSafe(F.col("fc")) & (F.col("kind") == F.col("fk")) & (F.col("call_id") == F.col("fi")))
    links = linked.select(F.col("conv_id").alias("kc"), F.col("call_id").alias("ki"), "call_turn", "result_turn", "called", "answered", "level")
    found = found.join(links, F.col("conv_id").eqNullSafe(F.col("kc")) & (F.col("call_id") == F.col("ki")))
    is_call = F.col("kind") == "call"
    status = (
        F.when(~place.eqNullSafe(F.col("first")), "duplicate").when(F.col("status") != "ok", F.col("status"))
        .when(is_call & F.col("level").isNull(), "cycle").when(is_call & F.col("answered").isNull(), "no_result")
        .when(~is_call & F.col("called").isNull(), "no_call").when(F.col("result_turn") <= F.col("call_turn"), "too_early").otherwise("ok")
    )
    linked_turn = F.when(is_call, F.col("result_turn")).otherwise(F.col("call_turn"))
    level = F.when(is_call, F.col("level"))
    named = found.select("conv_id", "turn", "part", "kind", "call_id", level.cast("int").alias("level"), linked_turn.alias("linked_turn"), status.alias("status"), "json")
    plain = events.where("call_id is null").select(
        "conv_id", "turn", "part", "kind", "call_id", F.lit(None).cast("int").alias("level"), F.lit(None).cast("long").alias("linked_turn"), "status", "json"
    )
    return plain.unionByName(named)
