"""Keys are found in objects and arrays at any level."""

from __future__ import annotations

import json
import re

from cutframe.operators import evidence as ev

PATTERN = "^(total|rank|mean|avg)"


def walk(node, path="$"):
    if isinstance(node, dict):
        for k, v in node.items():
            if re.search(PATTERN, k):
                yield f"{path}.{k}"
            yield from walk(v, f"{path}.{k}")
    elif isinstance(node, list):
        for i, v in enumerate(node):
            yield from walk(v, f"{path}[{i}]")


def test_any_level(spark):
    deep = {"rank": 1}
    for i in range(24):
        deep = {"x": deep, "y": i} if i % 2 else [i, deep]
    docs = [
        {"events": [{"candidates": [{"id": 1, "total_s": 2, "scores": {"mean_x": [{"rank": 1}]}}, {"avg": None}]}, {}]},
        [[{"total": 1}], {"a": {"b": {"c": {"d": {"e": {"f": {"rank_1": 0}}}}}}}],
        deep,
        {"text": '{"total": 1}', "q": 'a " [{ \\ ', "rank": "[{"},
        {"x": [1, 2], "y": None},
        7,
    ]
    texts = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(90, None), (91, ""), (92, "[broken"), (93, "  [{\"total\": 1}]")]
    want = sorted((i, p) for i, d in enumerate(docs) for p in walk(d)) + [(93, "$[0].total")]
    got = ev.aggregate_hits(spark.createDataFrame(texts, "doc_id long, json string"), PATTERN).collect()
    assert sorted((r.doc_id, r.path) for r in got) == want
    assert ev.aggregate_hits(spark.createDataFrame([], "doc_id long, json string"), PATTERN).count() == 0


def test_a_thousand_levels_and_odd_keys(spark):
    deep = '{"x": [' * 700 + '{"rank": 1}' + "]}" * 700
    odd = '{"to\\u0074al": 1, "a\\"rank": {"avg:,{": [{}, [], {"mean": []}]}, "s": "{\\"total\\": [1}"}'
    docs = [(1, deep), (2, odd), (3, '{"total": 1'), (4, '{"total": 1]'), (5, '[}'), (6, "[" * 3000 + "]" * 3000), (7, '{"total": 1, "total": 2}')]
    got = sorted(tuple(r) for r in ev.aggregate_hits(spark.createDataFrame(docs, "doc_id int, json string"), PATTERN).collect())
    want = [(1, "$" + ".x[0]" * 700 + ".rank"), (2, "$.total"), (2, '$.a"rank.avg:,{'), (2, '$.a"rank.avg:,{[2].mean'), (7, "$.total"), (7, "$.total")]
    assert got == sorted(want)
