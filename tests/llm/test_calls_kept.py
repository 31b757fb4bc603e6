"""No answer and no call is lost, and records are strict JSON."""

from __future__ import annotations

import json

from cutframe.llm import toolcalls
from cutframe.llm.common import ship_package


def linked(spark, *rows):
    ship_package(spark)
    df = spark.createDataFrame(list(rows), "conv_id long, turn long, role string, text string")
    return {(r.call_id, r.tool): r for r in toolcalls.link_tool_calls(df).collect()}


def strict(text):
    def no(_):
        raise ValueError

    return json.loads(text, parse_constant=no)


def test_empty_tool_calls_are_an_answer(spark):
    for text in ('{"tool_calls":[]}', '{"tool_calls":[1, "x"]}', '{"tool_calls":{}}'):
        (r,) = linked(spark, (1, 0, "user", "hi"), (1, 1, "assistant", text)).values()
        assert (r.status, strict(r.record)["result"]) == ("linked", text)


def test_explicit_ids_that_look_implicit(spark):
    call = json.dumps({"tool_calls": [{"id": "turn-1", "name": "f", "arguments": {}}, {"id": "b", "name": "f", "depends_on": ["turn-1"]}, {"id": "c", "name": "f", "depends_on": ["turn-3"]}]})
    got = linked(spark, (1, 0, "assistant", call), (1, 1, "user", "hi"), (1, 2, "assistant", "yes"), (1, 3, "user", "and?"), (1, 4, "tool", '{"tool_call_id":"turn-1","content":"out"}'))
    assert {k: (r.status, r.copies, r.level) for k, r in got.items()} == {
        ("turn-1", "f"): ("linked", 1, 0),
        ("turn-1", "respond"): ("linked", 1, 0),
        ("turn-3", "respond"): ("unanswered", 1, 1),
        ("b", "f"): ("unanswered", 1, 1),
        ("c", "f"): ("unanswered", 1, 2),
    }
    assert [strict(got["turn-1", t].record)["result"] for t in ("f", "respond")] == ["out", "yes"]


def test_numbers_that_are_no_json(spark):
    for bad in ("NaN", "-Infinity", "1e999"):
        text = f'{{"tool_calls":[{{"id":"a","name":"f","arguments":{{"x":{bad}}}}}]}}'
        got = linked(spark, (1, 0, "user", "hi"), (1, 1, "assistant", text), (1, 2, "user", f'{{"prompt":{bad}}}'), (1, 3, "tool", f'{{"tool_call_id":"a","content":{bad}}}'))
        assert all(strict(r.record) for r in got.values()) and {k for k, _ in got} == {"turn-0", "turn-2"}
        assert strict(got["turn-0", "respond"].record)["result"] == text
        inner = json.dumps({"tool_calls": [{"id": "a", "name": "f", "arguments": f'{{"x": {bad}}}'}]})
        assert strict(linked(spark, (1, 0, "assistant", inner))["a", "f"].record)["arguments"] == f'{{"x": {bad}}}'
