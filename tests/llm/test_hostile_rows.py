"""Hostile JSON, orders, clashing names and long texts for tool calls, redaction and language ID."""

from __future__ import annotations

import json
import math
import random
import zlib
from collections import Counter

import numpy as np

from cutframe.llm import langid, secrets, toolcalls
from cutframe.llm import queries as q


def call(*calls):
    return json.dumps({"tool_calls": list(calls)})


def linked(spark, messages):
    df = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string")
    return {(r.conv_id, r.call_id): r for r in toolcalls.link_tool_calls(df).collect()}


def test_hostile_json(spark):
    deep = '{"tool_calls":' + "[" * 60_000 + "]" * 60_000 + "}"
    got = linked(spark, [
        (1, 0, "user", "a"),
        (1, 1, "assistant", deep),
        (2, 0, "assistant", '{"tool_calls": [{"id": "\\ud800x", "name": "respond", "arguments": {"prompt": "\\udfff"}}]}'),
        (2, 1, "tool", '{"tool_call_id": "\\ud800x", "content": "\\ud83d"}'),
        (3, 0, "assistant", call({"id": "a", "name": "respond", "arguments": {"prompt": "p"}, "depends_on": 7}, {"id": "b", "name": "respond", "arguments": {"prompt": "p"}, "depends_on": [{"x": 1}]}, {"id": "before-1", "name": "respond", "arguments": {"prompt": "p"}}, {"id": "c", "name": "respond", "arguments": {"prompt": "p"}, "depends_on": ["before-1", "nowhere"]})),
    ])
    assert got[1, "turn-0"].status == "linked" and json.loads(got[1, "turn-0"].record)["result"] == deep
    assert got[2, "\\ud800x"].status == "linked" and json.loads(got[2, "\\ud800x"].record)["arguments"] == {"prompt": "\udfff"}
    assert got[3, "a"].problems == got[3, "b"].problems == "$.depends_on: not a list of ids" and got[3, "a"].level == 0
    assert got[3, "c"].level == 1 and got[3, "c"].problems == "$.depends_on: no call nowhere" and got[3, "before-1"].problems == ""


def test_orders(spark):
    """Plain dialogues are ranked over stretches of turns; explicit and implicit dependencies mix; repeated results are counted."""
    turns = [t for t in range(0, 5000, 2) if t == 0 or t % 1023]
    messages = [(1, t, "user", "x") for t in turns] + [(1, 1, "assistant", "y"), (1, 1, "assistant", "z")]
    messages += [(2, 0, "user", "x"), (2, 1, "assistant", call({"id": "k", "name": "respond", "depends_on": ["turn-2"]})), (2, 2, "user", "x"), (2, 3, "assistant", call({"id": "m", "name": "respond", "depends_on": ["k"]}))]
    chain = [{"id": f"s{i}", "name": "respond", "depends_on": [f"s{i + 1}"] if i < 11 else []} for i in range(12)]
    messages += [(3, 0, "assistant", call(*chain)), (3, 1, "user", "x")]
    got = linked(spark, messages)
    assert [got[1, f"turn-{t}"].level for t in turns] == list(range(len(turns)))
    assert got[1, "turn-0"].results == 2 and got[1, "turn-0"].copies == 1
    assert [got[2, i].level for i in ("turn-0", "turn-2", "k", "m")] == [0, 1, 2, 3]
    assert [got[3, f"s{i}"].level for i in range(12)] == [11 - i for i in range(12)] and got[3, "turn-1"].level == 0


def test_redaction_keeps_columns_of_any_name(spark):
    names = ["spans", "secrets", "n_hex", "_text", "_whole", "_row", "_base", "base_sha256", "n_assign"]
    df = spark.createDataFrame([("token = abcdefgh12", *range(len(names))), (None, *range(len(names)))], "text string, " + ", ".join(f"{n} int" for n in names))
    rows = secrets.redact(df)
    assert rows.schema == df.schema
    assert [tuple(r) for r in rows.collect()] == [("[REDACTED]", *range(len(names))), (None, *range(len(names)))]


def test_grams_of_long_texts_are_those_of_the_whole(monkeypatch):
    text = "".join(random.Random(1).choice("abc déf ÄÖ") for _ in range(900)).encode()
    whole = langid.ngram_counts(text)
    monkeypatch.setattr(langid, "STEP", 7)
    assert (langid.ngram_counts(text) == whole).all() and whole.sum() == 3 * (len(text) + 2) - 6
    assert langid.ngram_counts(b"a").sum() == 3 and langid.ngram_counts(b"").sum() == 1


def test_op3_equals_plain_decoding(spark, sf_dir):
    """The same classifiers from counts taken gram by gram, decoded one bit after another."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()

    def counts(text):
        b, out = b" " + text.encode().lower() + b" ", Counter()
        for n, salt in ((2, 0x9E3779B1), (3, 0x85EBCA77), (4, 0xC2B2AE3D)):
            for i in range(len(b) - n + 1):
                out[(int.from_bytes(b[i : i + n], "little") * salt % 2**32) >> 18] += 1
        return out

    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    of = {d.doc_id: counts(d.text) for d in docs if d.text}
    languages = sorted({d.lang for d in docs if d.text is not None and d.lang is not None and not held(d.doc_id)})
    total = np.zeros((len(languages), langid.DIMENSIONS))
    for d in docs:
        if d.text and d.lang is not None and not held(d.doc_id):
            root = max(1.0, math.sqrt(sum(of[d.doc_id].values())))
            for g, n in of[d.doc_id].items():
                total[languages.index(d.lang), g] += n / root
    share = (total + 0.01) / (total + 0.01).sum(axis=1, keepdims=True)
    codes = langid.codewords(len(languages), 15)
    weights, trust = [], []
    for bit in codes.T:
        w = np.log(share[bit > 0].mean(axis=0)) - np.log(share[bit < 0].mean(axis=0))
        weights.append(w)
        trust.append(max(0.05, math.tanh(min(bit[j] * float(share[j] @ w) for j in range(len(languages))))))
    trust = [t / sum(trust) * len(trust) for t in trust]
    for r in q.op3_language_id(spark, sf_dir).collect():
        text = next(d.text for d in docs if d.doc_id == r.doc_id)
        if not text or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        n = sum(of[r.doc_id].values())
        loss = [0.0] * len(languages)
        for b, w in enumerate(weights):
            margin = max(-30.0, min(30.0, sum(w[g] * c for g, c in of[r.doc_id].items()) / math.sqrt(n)))
            for j in range(len(languages)):
                loss[j] += trust[b] * math.log1p(math.exp(-codes[j, b] * margin))
        near = [math.exp(min(loss) - x) for x in loss]
        assert r.lang_pred == languages[loss.index(min(loss))] and abs(r.score - max(near) / sum(near)) < 1e-6
