"""Tool calls of conversations: linked to their results, ordered, validated, written as canonical JSON.

A message (``conv_id, turn, role, text``) is plain text, or a JSON object: from an assistant
``{"content": .., "tool_calls": [{"id", "name", "arguments", "after": [ids]}]}``, from a tool
``{"tool_call_id": .., "content": ..}``. It becomes one row for its content and one for each call.

* Linking: calls and results are joined on (conversation, identifier). Of repeated calls or results with
  one identifier the first counts; later ones are marked ``repeated``. A call without a result and a
  result without a call are ``unlinked``.
* Order: a result comes after its call, a call after the calls it names in ``after`` and their results.
  Calls that stand before something they need are moved behind it, and in rounds the calls that need a
  moved one; the rounds are as many as such calls follow each other, none where all is in order. The
  order is given as columns to sort by (``place_turn, place_part, depth, turn, part``), so no
  conversation has to be in one task. Calls in a cycle, or behind one, keep their own place and are marked
  ``cyclic``; named calls that don't exist are ignored.
* Arguments are checked against the schema of the call's name (a stated subset of JSON Schema).

Null text is empty content; text that is no such object is plain content. Rows with a null conversation or turn
are kept, but link with nothing and have their own place. Repeated rows stand at one place and have
the same links. Other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import prepare, stored

#: Bytes of schemas that are sent to the workers at most.
SCHEMA_BYTES = 4 << 20

_TYPES = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
}


def violation(value: Any, schema: dict, at: str = "$") -> str | None:
    """The first rule of ``schema`` that ``value`` breaks, or None.

    Known rules: type, enum, const, minimum, maximum, minLength, maxLength, pattern, items, minItems,
    maxItems, properties, required, additionalProperties.
    """
    kinds = schema.get("type")
    if kinds is not None and not any(_TYPES[k](value) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return f"{at}: type"
    if "enum" in schema and not any(canonical(value) == canonical(x) for x in schema["enum"]):
        return f"{at}: enum"
    if "const" in schema and canonical(value) != canonical(schema["const"]):
        return f"{at}: const"
    if _TYPES["number"](value):
        if value < schema.get("minimum", value):
            return f"{at}: minimum"
        if value > schema.get("maximum", value):
            return f"{at}: maximum"
    if isinstance(value, str):
        if not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
            return f"{at}: length"
        if "pattern" in schema and not re.search(schema["pattern"], value):
            return f"{at}: pattern"
    if isinstance(value, list):
        if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value)):
            return f"{at}: items"
        for i, x in enumerate(value):
            if "items" in schema and (found := violation(x, schema["items"], f"{at}[{i}]")):
                return found
    if isinstance(value, dict):
        for name in schema.get("required", ()):
            if name not in value:
                return f"{at}.{name}: required"
        known = schema.get("properties", {})
        more = schema.get("additionalProperties", True)
        for name in sorted(value):
            rule = known.get(name, more if isinstance(more, dict) else None)
            if rule is None and name not in known and more is False:
                return f"{at}.{name}: unknown"
            if rule and (found := violation(value[name], rule, f"{at}.{name}")):
                return found
    return None


def _plain(value: Any) -> Any:
    if isinstance(value, float) and value.is_integer() and abs(value) < 2**53:
        return int(value)
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return [_plain(v) for v in value] if isinstance(value, list) else value


def canonical(value: Any) -> str:
    """JSON with sorted keys, no spaces, whole numbers without a fraction, and text as it is."""
    text = json.dumps(_plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    try:
        text.encode()
    except UnicodeEncodeError:  # half of a surrogate pair can only be written escaped
        text = json.dumps(_plain(value), sort_keys=True, separators=(",", ":"))
    return text


def _no_constant(name: str):
    raise ValueError(name)


def _object(text: str) -> dict | None:
    if not text.lstrip().startswith("{"):
        return None
    try:
        value = json.loads(text, parse_constant=_no_constant)
        canonical(value)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def parts(role: str | None, text: str | None, schemas: dict[str, dict]) -> list[dict]:
    """The rows of one message, without its place."""
    body = text or ""
    value = _object(body) if role in ("assistant", "tool") else None
    if value is not None and role == "tool" and isinstance(value.get("tool_call_id"), str):
        line = {"role": role, "tool_call_id": value["tool_call_id"], "content": value.get("content")}
        return [{"kind": "result", "call_id": value["tool_call_id"], "json": canonical(line)}]
    if value is None or role != "assistant" or not isinstance(value.get("tool_calls"), list):
        return [{"kind": "message", "json": canonical({"role": role, "content": body})}]
    out = [{"kind": "message", "json": canonical({"role": role, "content": value["content"]})}] if "content" in value else []
    for call in value["tool_calls"]:
        call = call if isinstance(call, dict) else {}
        name, arguments, after = call.get("name"), call.get("arguments"), call.get("after")
        if isinstance(arguments, str):  # arguments are often sent as JSON text
            arguments = _object(arguments) if _object(arguments) is not None else arguments
        call_id = call.get("id") if isinstance(call.get("id"), str) else None
        if call_id is None:
            error = "no identifier"
        elif not isinstance(name, str) or name not in schemas:
            error = "no schema"
        else:
            error = violation(arguments, schemas[name])
        line = {"role": role, "id": call_id, "name": name, "arguments": arguments}
        named = sorted({x for x in after if isinstance(x, str) and x != call_id}) if isinstance(after, list) else []
        out.append({"kind": "call", "call_id": call_id, "json": canonical(line), "error": error, "after": named})
    return out or [{"kind": "message", "json": canonical({"role": role, "content": ""})}]


_ROWS = "conv_id long, turn long, part int, kind string, call_id string, error string, after array<string>, json string"
_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("turn", pa.int64()), ("part", pa.int32()), ("kind", pa.string()), ("call_id", pa.string()), ("error", pa.string()), ("after", pa.list_(pa.string())), ("json", pa.string())]
)


def _parsed(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    if len(json.dumps(schemas)) > SCHEMA_BYTES:
        raise ValueError(f"the schemas are larger than {SCHEMA_BYTES} bytes")

    def run(batches):
        for b in batches:
            rows = []
            for conv, turn, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rows += [{"conv_id": conv, "turn": turn, "part": i, **p} for i, p in enumerate(parts(role, text, schemas))]
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    chosen = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, _ROWS)


def _settled(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, place, depth`` of the calls that can't keep their own place; ``cyclic`` marks the rest.

    ``calls`` has ``own`` (its turn and part), ``done`` (the later of it and its result) and ``after``. Only
    calls that stand before something they need are moved, and then those that need a moved call.
    """
    ends = calls.select("conv_id", F.col("call_id").alias("needed"), "done")
    asked = calls.select("conv_id", "call_id", "own", F.explode("after").alias("needed"))
    needs = stored(asked.join(ends, ["conv_id", "needed"]), "needs")
    best = F.max(F.struct(F.col("end").alias("place"), F.col("level").alias("depth"))).alias("best")

    def moved(edges: DataFrame) -> DataFrame:
        """The latest place, and then the greatest depth, that the edges ask of each call."""
        late = edges.filter("end >= own").groupBy("conv_id", "call_id").agg(best)
        return late.select("conv_id", "call_id", "best.place", "best.depth")

    state = stored(moved(needs.withColumn("end", F.col("done")).withColumn("level", F.lit(1).cast("long"))), "moved")
    if not state.limit(1).count():
        return state.withColumn("cyclic", F.lit(False))
    # What a moved call may move in turn: calls reachable from it, found by following the edges once.
    changed, rounds = state, 1
    while True:
        last = changed.select("conv_id", F.col("call_id").alias("needed"), "place", "depth")
        edges = needs.join(last, ["conv_id", "needed"]).withColumn("end", F.greatest("place", "done")).withColumn("level", F.col("depth") + 1)
        asked = moved(edges.select("conv_id", "call_id", "own", "end", "level"))
        old = state.select("conv_id", "call_id", F.col("place").alias("had_place"), F.col("depth").alias("had_depth"))
        more = asked.join(old, ["conv_id", "call_id"], "left").filter(
            "had_place IS NULL OR place > had_place OR (place = had_place AND depth > had_depth)"
        )
        changed = stored(more.select("conv_id", "call_id", "place", "depth"), "changed")
        if not changed.limit(1).count():
            return state.withColumn("cyclic", F.lit(False))
        kept = state.join(changed, ["conv_id", "call_id"], "left_anti")
        state = stored(kept.unionByName(changed), "moved")
        rounds += 1
        # A chain has as many steps as moved calls at most; who still changes after them is in a cycle or behind one.
        most = state.groupBy("conv_id").agg(F.count("*").alias("n"))
        if (most.agg(F.max("n")).first()[0] or 0) < rounds:
            endless = changed.select("conv_id", "call_id", F.lit(True).alias("endless"))
            endless = stored(_reached(needs, endless), "endless")
            marked = state.join(endless, ["conv_id", "call_id"], "left")
            return marked.select("conv_id", "call_id", "place", "depth", F.coalesce("endless", F.lit(False)).alias("cyclic"))


def _reached(needs: DataFrame, start: DataFrame) -> DataFrame:
    """``start`` and every call that needs one of it, directly or not."""
    found = stored(start.select("conv_id", "call_id").distinct(), "reached")
    while True:
        step = needs.join(found.select("conv_id", F.col("call_id").alias("needed")), ["conv_id", "needed"]).select("conv_id", "call_id")
        new = stored(step.distinct().join(found, ["conv_id", "call_id"], "left_anti"), "reached")
        if not new.limit(1).count():
            return found.withColumn("endless", F.lit(True))
        found = stored(found.union(new), "reached")


def format_calls(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``conv_id, turn, part, kind, call_id, linked, valid, error, place_turn, place_part, depth, json``."""
    prepare(messages.sparkSession)
    rows = stored(_parsed(messages, schemas).withColumn("own", F.struct("turn", "part")), "parts")
    able = rows.filter("conv_id IS NOT NULL AND turn IS NOT NULL AND call_id IS NOT NULL")
    calls = able.filter("kind = 'call'").groupBy("conv_id", "call_id").agg(F.min(F.struct("own", "after")).alias("first"))
    results = able.filter("kind = 'result'").groupBy("conv_id", "call_id").agg(F.min("own").alias("answered"))
    links = calls.join(results, ["conv_id", "call_id"], "full").select(
        "conv_id", "call_id", F.col("first.own").alias("called"), "answered", F.col("first.after").alias("after")
    )
    links = stored(links, "links")
    known = links.filter("called IS NOT NULL").select("conv_id", "call_id", F.col("called").alias("own"), F.coalesce(F.greatest("called", "answered"), "called").alias("done"), "after")
    order = _settled(known).withColumnRenamed("depth", "level")
    tags = links.drop("after").join(order, ["conv_id", "call_id"], "left")
    # Only parts with an identifier are joined: the others would all have the key null.
    named = F.col("call_id").isNotNull()
    joined = rows.filter(named).join(tags, ["conv_id", "call_id"], "left").unionByName(rows.filter(~named), allowMissingColumns=True)

    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"
    counts = (is_call & F.col("own").eqNullSafe(F.col("called"))) | (is_result & F.col("own").eqNullSafe(F.col("answered")))
    linked = F.when(is_call | is_result, counts & F.col("called").isNotNull() & F.col("answered").isNotNull())
    marks = (
        F.when(~is_call & ~is_result, None)
        .when(F.col("called").isNull() & F.col("answered").isNull(), F.lit("unlinked"))
        .when(~counts, F.lit("repeated"))
        .when(~linked, F.lit("unlinked"))
        .when(F.col("cyclic"), F.lit("cyclic"))
    )
    # Repeated and cyclic parts keep their own place, and so do calls that nothing moves.
    free = counts & ~F.coalesce("cyclic", F.lit(False))
    at = F.when(free, F.coalesce("place", "called"))
    place = F.when(is_result & F.col("called").isNotNull(), F.greatest(at, F.col("own"))).when(is_call, at)
    place = F.coalesce(place, F.col("own"))
    depth = F.when(free & F.col("called").isNotNull(), F.coalesce("level", F.lit(0)) * 2 + is_result.cast("long")).otherwise(0)
    return joined.select(
        "conv_id", "turn", "part", "kind", "call_id", linked.alias("linked"), F.when(is_call, F.col("error").isNull()).alias("valid"),
        F.nullif(F.concat_ws("; ", "error", marks), F.lit("")).alias("error"), place["turn"].alias("place_turn"), place["part"].alias("place_part"), depth.alias("depth"), "json",
    )
