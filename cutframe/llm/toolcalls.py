"""Chat formatting: tool calls linked with their results, ordered, validated and serialised.

Messages (conv_id, turn, role, text) hold calls and results in one of two forms. Explicit: an assistant text that is a JSON
object with `tool_calls` (id, name, arguments, depends_on), and a tool text that is a JSON object with
`tool_call_id` and `content`. Implicit: a user's turn calls the tool `respond` with the text as its prompt, an
assistant's turn, one whose `tool_calls` hold no object among them, is the result of the call one turn earlier, and each such call depends on the implicit one before it. Other turns give no row.

Calls and results meet in a hash join on (conversation, call id), explicit and implicit ones apart, so that an explicit `turn-1` hides nothing; a dependency means the explicit call of
that id, if there is one; of repeated ids the first by turn counts, `copies` and
`results` tell how many there were. A call's level is 0 without dependencies, else one more than the highest of those it depends on; calls on or
behind a cycle get -1. In conversations of implicit calls alone that is their rank, counted in bounded stretches of turns; conversations with
`depends_on` are peeled level by level, in as many rounds of joins as their longest chain has calls. Sorting by (level, turn, place) is a
topological order; no conversation is gathered in one task. Arguments are checked against the tool's schema; dependencies that aren't a list or name
no call of the conversation are problems too. The record is canonical JSON: sorted keys, no spaces, no escapes that JSON doesn't need; half a
surrogate pair, which UTF-8 can't hold, stands as its escape.

Texts that don't parse, those nested too deep or with NaN or infinite numbers among them, are plain texts. Null texts and roles take no part; a null conversation id is a conversation of its own. Empty tables give empty results.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written

#: Turns of one conversation that are ranked in one task at most.
STRETCH = 1024
#: The tool that a plain dialogue uses, as a JSON-Schema-like rule.
RESPOND = {"respond": {"type": "object", "properties": {"prompt": {"type": "string", "minLength": 1}}, "required": ["prompt"], "additionalProperties": False}}
_KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}


def utf8(text: str) -> str:
    """text with half surrogate pairs as their escapes."""
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value: object) -> str:
    return utf8(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def _refused(constant: str) -> None:
    raise ValueError(f"{constant} is no JSON")


def problems(value: object, schema: dict, at: str = "$") -> list[str]:
    """What is wrong with a value under type, enum, minLength, minimum, maximum, properties, required, additionalProperties and items."""
    kind = schema.get("type")
    if kind and (not isinstance(value, _KINDS[kind]) or kind in ("integer", "number") and isinstance(value, bool)):
        return [f"{at}: not {kind}"]
    found = [f"{at}: not in enum"] if "enum" in schema and value not in schema["enum"] else []
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        found.append(f"{at}: too short")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        found += [f"{at}: under {schema['minimum']}"] if value < schema.get("minimum", value) else []
        found += [f"{at}: over {schema['maximum']}"] if value > schema.get("maximum", value) else []
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                found += problems(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            found += problems(x, schema["items"], f"{at}[{i}]")
    return found


def _object(text: str) -> dict | None:
    if text.lstrip()[:1] == "{":
        try:
            value = json.loads(text, parse_constant=_refused)
            canonical(value)  # numbers beyond a double raise as well
        except (ValueError, RecursionError):
            return None
        return value if isinstance(value, dict) else None
    return None


def _events_of(conv: object, turn: int, role: str, text: str) -> Iterator[tuple]:
    """(kind, call id, place, tool, arguments as JSON, dependencies, what is wrong with them, implicit, content)"""
    value = _object(text) if role in ("assistant", "tool") else None
    made = value.get("tool_calls") if value else None
    asked = [x for x in made if isinstance(x, dict)] if role == "assistant" and isinstance(made, list) else []
    if asked:
        for i, c in enumerate(asked):
            f = c.get("function") if isinstance(c.get("function"), dict) else c
            arguments = f.get("arguments", {})
            if isinstance(arguments, str):
                arguments = _object(arguments) if _object(arguments) is not None else arguments
            needs = c.get("depends_on")
            fine = needs is None or isinstance(needs, list) and all(isinstance(d, (str, int)) for d in needs)
            yield "call", utf8(str(c.get("id"))), i, utf8(str(f.get("name"))), canonical(arguments), [utf8(str(d)) for d in needs or []] if fine else [], None if fine else "$.depends_on: not a list of ids", False, None
    elif role == "tool":
        if value and "tool_call_id" in value:
            content = value.get("content")
            yield "result", utf8(str(value["tool_call_id"])), 0, None, None, [], None, False, utf8(content) if isinstance(content, str) else canonical(content)
    elif role == "user":
        yield "call", f"turn-{turn}", 0, "respond", canonical({"prompt": text}), [], None, True, None
    elif role == "assistant":
        yield "result", f"turn-{turn - 1}", 0, None, None, [], None, True, text


_EVENT = "conv_id bigint, turn bigint, kind string, call_id string, place int, tool string, arguments string, needs array<string>, flaw string, implicit boolean, content string"


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(c, t, *e) for c, t, r, x in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text")), strict=True) for e in _events_of(c, t, r, x)]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.bool_(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[x.strip().split(" ")[0] for x in _EVENT.split(",")])


def _records(schemas: dict):
    """Validation and canonical JSON, row by row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wrong, text = [], []
            for call, tool, arguments, content, linked, flaw in zip(*(batch.column(c).to_pylist() for c in ("call_id", "tool", "arguments", "content", "status", "flaw")), strict=True):
                value = json.loads(arguments) if arguments is not None else None
                if tool is None:
                    wrong.append(None)
                else:
                    wrong.append(utf8("; ".join((problems(value, schemas[tool]) if tool in schemas else [f"unknown tool {tool}"]) + ([flaw] if flaw else []))))
                text.append(canonical({"arguments": value, "id": call, "name": tool, "result": content if linked != "unanswered" else None}))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(wrong, pa.string()), pa.array(text, pa.string())], names=[*batch.schema.names, "problems", "record"])

    return work


def _ranks(calls: DataFrame) -> DataFrame:
    """(conv, key, rank, before): the rank of each implicit call in its conversation, and the call before it.

    A conversation can be any part of all rows, so rows are ranked inside stretches of turns, and stretches by their sums.
    """
    rows = calls.filter("implicit").select("conv", "key", "turn", F.expr(f"floor(turn / {STRETCH})").alias("stretch"))
    sums = rows.groupBy("conv", "stretch").agg(F.count("*").alias("n"), F.max("turn").alias("last"))
    earlier = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("conv", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"), F.max("last").over(earlier).alias("last"))
    inside = Window.partitionBy("conv", "stretch").orderBy("turn")
    ranked = rows.withColumns({"k": F.row_number().over(inside), "lag": F.lag("turn").over(inside)}).join(base, ["conv", "stretch"])
    return ranked.select("conv", "key", (F.col("base") + F.col("k") - 1).alias("rank"), F.concat(F.lit("i:turn-"), F.coalesce("lag", "last").cast("string")).alias("before"))


def _levels(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """(conv, key, level) by peeling: each round takes the calls that need none of the rest; what is left in the end is on or behind a cycle."""
    left = written(calls.select("conv", "key"), "left")
    edges = written(needs.select("conv", "key", "need").distinct(), "needs")
    out, level = None, 0
    while True:
        ready = written(left.join(edges.select("conv", "key").distinct(), ["conv", "key"], "left_anti"), "ready")
        if not ready.limit(1).count():
            rest = left.withColumn("level", F.lit(-1).cast("bigint"))
            return rest if out is None else out.unionByName(rest)
        done = ready.withColumn("level", F.lit(level).cast("bigint"))
        out = done if out is None else out.unionByName(done)
        before = (left, edges)
        left = written(left.join(ready, ["conv", "key"], "left_anti"), "left")
        edges = written(edges.join(ready.withColumnRenamed("key", "need"), ["conv", "need"], "left_anti"), "needs")
        discard(*before)
        level += 1


def link_tool_calls(messages: DataFrame, *, schemas: dict | None = None) -> DataFrame:
    """One row per call, and per result without a call: conv_id, call_id, level, turn, place, tool, result_turn, status
    (linked, unanswered or orphan), copies, results, problems (empty: valid; null: no call) and record."""
    rows = messages.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text").filter("role is not null and text is not null and turn is not null")
    events = written(rows.mapInArrow(_events, _EVENT).withColumns({"conv": F.coalesce(F.col("conv_id").cast("string"), F.lit("")), "key": F.concat(F.when(F.col("implicit"), "i:").otherwise("e:"), "call_id")}), "chat-events")
    first = F.min(F.struct("turn", "place", "tool", "arguments", "needs", "flaw", "implicit", "content")).alias("m")
    calls = events.filter("kind = 'call'").groupBy("conv", "key").agg(first, F.count("*").alias("copies"), F.max("conv_id").alias("conv_id")).select("conv", "conv_id", "key", "copies", "m.turn", "m.place", "m.tool", "m.arguments", "m.needs", "m.flaw", "m.implicit")
    results = events.filter("kind = 'result'").groupBy("conv", "key").agg(first, F.count("*").alias("results"), F.max("conv_id").alias("rc")).select("conv", "key", "rc", "results", F.col("m.turn").alias("result_turn"), F.col("m.content").alias("content"))
    ranks = _ranks(calls)
    linked = calls.join(results, ["conv", "key"], "full").withColumn("call_id", F.substring("key", 3, 1 << 30))
    status = F.when(F.col("tool").isNull(), "orphan").when(F.col("result_turn").isNull(), "unanswered").otherwise("linked")
    linked = linked.withColumns({"status": status, "conv_id": F.coalesce("conv_id", "rc"), "copies": F.coalesce("copies", F.lit(0)), "results": F.coalesce("results", F.lit(0))})
    linked = linked.join(ranks.select("conv", "key", "rank"), ["conv", "key"], "left")
    level = F.col("rank")
    if events.filter("size(needs) > 0").limit(1).count():
        needs = calls.select("conv", "key", F.explode("needs").alias("name")).distinct()
        known = calls.groupBy("conv", F.substring("key", 3, 1 << 30).alias("name")).agg(F.min("key").alias("need"))  # explicit before implicit
        needs = written(needs.join(known, ["conv", "name"], "left"), "named-needs")
        lost = needs.filter("need is null").groupBy("conv", "key").agg(F.array_join(F.array_sort(F.collect_set("name")), ", ").alias("lost"))
        some = needs.filter("need is not null").select("conv").distinct()
        chained = ranks.filter("before is not null").select("conv", "key", F.col("before").alias("need"))
        edges = needs.filter("need is not null").select("conv", "key", "need").unionByName(chained.join(some, "conv", "left_semi"))
        levels = _levels(calls.join(some, "conv", "left_semi"), edges)
        linked = linked.join(levels, ["conv", "key"], "left").join(lost, ["conv", "key"], "left")
        linked = linked.withColumn("flaw", F.nullif(F.concat_ws("; ", "flaw", F.concat(F.lit("$.depends_on: no call "), "lost")), F.lit("")))
        level = F.coalesce("level", "rank")
    linked = linked.withColumn("level", F.coalesce(level, F.lit(0)).cast("bigint"))
    names = ["conv_id", "call_id", "level", "turn", "place", "tool", "result_turn", "status", "copies", "results", "arguments", "content", "flaw"]
    slim = linked.select(*names)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in slim.schema) + ", problems string, record string"
    return slim.mapInArrow(_records(schemas or RESPOND), schema).drop("arguments", "content", "flaw")
