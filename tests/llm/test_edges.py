"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cutframe.llm import ann, decontaminate, langid, neardup, packing, secrets, substrings, tokenfiles, toolcalls, warc
from cutframe.llm.graphs import components, extended
from cutframe.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, spans int, length double, start string"


def rows(*texts):
    return [(i if i != 3 else None, t, "en" if i % 2 else None, None, None, "s", 7, 1.5, "x") for i, t in enumerate(texts)]


LONG = " ".join(f"w{i % 5000}" for i in range(60_000))
TEXTS = ["the cat sat on the mat and went home", None, "", "   \n\t ", "le chat est sur la table", "the cat sat on the mat and went home", "12345 !!", LONG, LONG, "x" * 60_000, "the cat sat on the mat and went home"]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows(*TEXTS) + rows(*TEXTS)[:3], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_language_id(odd, none):
    model = langid.fit(odd)
    out = langid.identify(odd, model)
    assert "score" in out.columns and out.columns.count("score") == 1 and dict(out.dtypes)["score"] == "double"
    got = {(r.text or "")[:5]: r.lang_pred for r in out.collect()}
    assert got[""] == got["12345"] == "und" and got["the c"] == "en"
    assert langid.identify(none, langid.fit(none)).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, langid.fit(none)).collect()} == {"und"}


def test_substrings(odd, none):
    out = substrings.remove_repeated_spans(odd).collect()
    assert len(out) == len(TEXTS) + 3
    for r in out:
        n = len((r.text or "").split())
        assert r.n_words == n and r.n_removed == (n if n >= 35 else 0)
    assert substrings.remove_repeated_spans(none).count() == 0


def test_near_duplicates(odd, none):
    out = neardup.near_duplicate_classes(odd.filter("doc_id is not null")).collect()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, set()).add(r.class_id)
    assert by[0] == by[5] == by[10] == {0} and by[7] == by[8] == {7} and by[1] == {1} and by[2] == {2} and by[9] == {9}
    kept = neardup.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    texts = [r.text for r in kept.collect()]
    assert sorted(t for t in texts if t and t.strip()) == sorted({t for t in TEXTS if t and t.strip()})
    assert sum(not (t and t.strip()) for t in texts) == 5
    assert neardup.near_duplicate_classes(none).count() == 0 and neardup.keep_one_of_each(none).count() == 0


def test_large_near_copy_group(spark):
    """A group larger than a small bucket, with links that only some members have: classes equal brute force."""
    from .test_query_results import classes_by_brute_force

    rng = random.Random(5)
    base = [f"a{rng.randrange(9999)}" for _ in range(120)]
    texts = {}
    for i in range(90):
        copy = list(base)
        for _ in range(rng.choice((1, 2, 3, 6))):
            copy[rng.randrange(len(copy))] = f"b{rng.randrange(9999)}"
        texts[i] = " ".join(copy)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in neardup.near_duplicate_classes(df).collect()} == classes_by_brute_force(texts)


@pytest.mark.parametrize("counted", [True, False])
def test_cloud_of_near_copies(spark, counted):
    """Copies too far from their originals to be linked to them, chains of closer ones among them, repeated lines and equal words in other white space."""
    from .test_query_results import classes_by_brute_force

    rng = random.Random(7)
    texts = {}
    bases = [[f"{k}a{rng.randrange(9999)}" for _ in range(150)] for k in range(2)]
    for i in range(220):
        copy = list(bases[i % 2])
        for _ in range(rng.choice((2, 4, 6, 8, 9))):
            copy[rng.randrange(len(copy))] = f"b{rng.randrange(99999)}"
        if i > 20 and i % 7 == 0:
            copy = texts[i - 20].split()
            copy[rng.randrange(len(copy))] = f"c{i}"
        if i % 11 == 0:
            copy += copy[:10] * rng.choice((1, 3, 5))
        texts[i] = " ".join(copy)
    for i in range(220, 240):
        texts[i] = texts[9].replace(" ", " " * (i - 210), 1)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in neardup.near_duplicate_classes(df, counted=counted).collect()}
    assert got == classes_by_brute_force(texts, counted=counted)


def test_weighted_signature_estimates_weighted_jaccard():
    rng = np.random.default_rng(1)
    items = rng.integers(1, 2**63, 60).astype(np.uint64)
    w1, w2 = rng.uniform(0.2, 4, 60), rng.uniform(0.2, 4, 60)
    a, b = neardup.dart_signature(items, w1, 2000), neardup.dart_signature(items, w2, 2000)
    assert abs((a == b).mean() - np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum()) < 0.06
    ones = neardup.dart_signature(items, np.ones(60), 500)
    assert (ones == neardup.dart_signature(items, None, 500)).all()


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (200, 200)]
    got = {r.id: r.comp for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    more = extended(components(spark.createDataFrame(links, "a long, b long")), spark.createDataFrame([(40, 102), (7, 9), (300, 301), (301, 5), (400, 401)], "a long, b long"))
    assert {r.id: r.comp for r in more.collect()} == {i: 0 for i in (*range(41), 100, 101, 102, 300, 301)} | {400: 400, 401: 400}


def test_secrets(odd, none):
    planted = odd.withColumn("text", F.when(F.col("doc_id") == 0, F.lit('é token = "aB3dE5gH7jK9mN1pQ3sT5" end')).otherwise(F.col("text")))
    out = {r.doc_id: r for r in secrets.scan(planted).collect()}
    assert out[0].spans == "assign:2:32,entropy_base64:11:32" and out[1].spans == "" and out[9].n_hex == 0
    red = secrets.redact(planted)
    assert red.columns == odd.columns and {r.text for r in red.filter("doc_id = 0").collect()} == {'é [REDACTED]" end'}
    assert red.filter("text is null").count() == odd.filter("text is null").count()
    assert secrets.scan(none).count() == 0


def test_entropy_by_counting_again(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("ab01" if i % 3 else "abcdefXYZ0123456789+/") for _ in range(rng.randrange(20, 60))) for i in range(40)]
    got = {r.w: r.e for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", secrets.window_entropy(F.col("w")).alias("e")).collect()}

    def entropy(s):
        p = np.array([s.count(c) for c in set(s)]) / len(s)
        return -(p * np.log2(p)).sum()

    for w in words:
        assert abs(got[w] - max(entropy(w[i : i + 20]) for i in range(len(w) - 19))) < 1e-9


def test_packing(odd, none):
    out = packing.pack(odd, tokenizer_path(), with_ids=True)
    assert out.columns.count("start") == 1 and out.columns.count("length") == 1
    tokens = out.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in tokens}[1] == 2  # two rows of the null text, one end id each
    assert all(len(r.ids) == 4 * r.length for r in out.select("ids", "length").collect())
    assert packing.pack(none, tokenizer_path()).count() == 0


def test_best_fit_decreasing_by_brute_force():
    rng = np.random.default_rng(3)
    for window in (1, 7, 64, 100):
        sizes = rng.integers(1, window + 1, 300)
        sequence, offset = packing.best_fit_decreasing(sizes, window)
        rooms = []
        for i in np.argsort(-sizes, kind="stable"):
            fits = [r for r in range(len(rooms)) if rooms[r] >= sizes[i]]
            if fits:
                best = min(rooms[r] for r in fits)
                assert window - offset[i] == best
                rooms[next(r for r in fits if rooms[r] == best)] -= sizes[i]
            else:
                assert offset[i] == 0
                rooms.append(window - sizes[i])
        assert len(set(sequence.tolist())) == len(rooms)


@pytest.mark.parametrize("quick", [True, False])
def test_encoders_agree(quick):
    e = packing.Encoder(tokenizer_path())
    if not quick:
        e.quick = None
    for t in ["", "Hello  world\n\n é 😀 don't", "<|endoftext|> x", "ab " * 50, "a" * 3000]:
        assert e.encode(t) == e.plain.encode(t, add_special_tokens=False).ids


def test_decontamination(spark, odd, none):
    items = spark.createDataFrame([(1, "the cat sat on the mat and went home"), (2, None), (3, ""), (1, "the cat sat on the mat and went home"), (4, "nothing of this is there at all anywhere")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(odd, items).collect()}
    assert got == {(0, 1), (5, 1), (10, 1)}
    clean = decontaminate.without_leaks(odd, items)
    assert clean.columns == odd.columns and clean.count() == odd.count() - 4
    assert decontaminate.leaks(none, items).count() == 0 and decontaminate.leaks(odd, items.limit(0)).count() == 0


def test_paraphrased_leak(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.choice((2, 3)))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(30) + ". " + text(6) + ".") for i in range(5)]
    changed = items[2][1].split()
    for at in (3, 9, 15, 21):
        changed[at] = "other"
    docs = [(i, text(300)) for i in range(60)] + [(100, text(77) + " " + " ".join(changed) + " " + text(50))]
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(100, 2)] and 0.8 < got[0].ratio < 1


def test_common_subsequence():
    assert decontaminate.common_subsequence(list("abcbdab"), list("bdcaba")) == 4
    assert decontaminate.common_subsequence([], ["x"]) == 0


FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Page-ID: 77\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


@pytest.mark.parametrize("block", ["1m", "64k"])
def test_warc_round_trip(spark, block):
    html = ["<p>x</p>" * 20, "<p>x</p>" * 20, None, "", FAKE, "a" + FAKE * 3 + "b\r\n\r\n", "WARC/1.1\r\n" * 50, "é" * 40_000 + "WARC/1.1\r\nContent-Length: 999999999\r\n\r\n" + "z" * 90_000, "short", "short", "<p>x</p>" * 20]
    ids = [5, 3, 1, 2, 4, 6, 7, 8, 9, 10, None]
    pages = spark.createDataFrame([(i, f"http://h/{i}\r\n", h, "clash") for i, h in zip(ids, html, strict=True)], "page_id long, url string, html string, digest string").coalesce(1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        got = {r.page_id: r for r in warc.archive(pages, with_payload=True).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert set(got) == set(ids)
    for i, h in zip(ids, html, strict=True):
        body = (h or "").encode()
        r = got[i]
        assert (r.payload_bytes, r.payload_digest, r.intact) == (len(body), hashlib.sha256(body).hexdigest(), True)
        if i in (5, None):
            assert (r.record_type, r.refers_to) == ("revisit", 3)
        else:
            assert (r.record_type, r.refers_to, r.payload) == ("response", None, body)


def test_warc_empty(spark):
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_token_files_across_blocks(spark, odd, none):
    path = tokenfiles.new_path(spark, "tokens")
    tokenfiles.write_token_files(odd, tokenizer_path(), path)
    e = packing.Encoder(tokenizer_path())
    want = sorted(len(e.encode(r.text or "")) for r in odd.collect())
    for block in (1, 7, 1000, 1 << 18):
        if block == 1:
            continue
        got = tokenfiles.token_counts(spark, path, block=block).collect()
        assert sorted(r.n_tokens for r in got) == want and all(r.terminated for r in got)
    assert tokenfiles.count_tokens(none, tokenizer_path(), keep=["doc_id"]).count() == 0


def test_token_counts_keep_end_ids_and_documents(spark, monkeypatch):
    end = "<|endoftext|>"
    texts = [f"one{end}two", end, f"{end}{end} x", None, "", "plain words", "y" * 25_000 + end, "plain words"]
    path = tokenfiles.new_path(spark, "docs")
    spark.createDataFrame([(i if i != 3 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, start string").repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    e = packing.Encoder(tokenizer_path())
    ids = [e.encode(t or "", ordinary=True) for t in texts]
    assert not any(50256 in x for x in ids) and e.plain.decode(ids[0]) == texts[0] and e.plain.decode(ids[6]) == texts[6]
    assert 50256 in e.encode(texts[0]) and 50256 in e.encode(texts[6])
    want = sorted((i if i != 3 else -1, len(x), "x") for i, x in enumerate(ids))
    for size in (10_000, 2):
        monkeypatch.setattr(tokenfiles, "FILE_DOCUMENTS", size)
        got = tokenfiles.count_tokens(docs, tokenizer_path(), keep=["doc_id", "start"]).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.start) for r in got) == want
    with pytest.raises(Exception, match="ends a document"):
        tokenfiles.count_tokens(docs, tokenizer_path(), end=ids[5][0]).count()


def test_tool_calls(spark):
    call = lambda *c: json.dumps({"tool_calls": list(c)})
    messages = [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", "hello"),
        (1, 1, "assistant", "hello"),
        (2, 0, "assistant", call({"id": "b", "name": "add", "arguments": {"y": 2, "x": 1}, "depends_on": ["c"]}, {"id": "a", "name": "add", "arguments": '{"x": "no"}'})),
        (2, 1, "tool", json.dumps({"tool_call_id": "a", "content": {"z": [1, "é"]}})),
        (2, 2, "assistant", call({"id": "c", "function": {"name": "nope", "arguments": {}}}, {"id": "p", "name": "add", "depends_on": ["q"]}, {"id": "q", "name": "add", "depends_on": ["p"]})),
        (2, 3, "tool", json.dumps({"tool_call_id": "zzz", "content": "?"})),
        (None, 0, "user", ""),
        (3, None, "user", "x"),
        (3, 0, None, "x"),
        (3, 0, "user", None),
    ]
    df = spark.createDataFrame([(*m, "clash") for m in messages], "conv_id long, turn long, role string, text string, level string")
    schemas = toolcalls.RESPOND | {"add": {"type": "object", "properties": {"x": {"type": "integer"}, "y": {"type": "integer", "maximum": 1}}, "required": ["x"]}}
    got = {(r.conv_id, r.call_id): r for r in toolcalls.link_tool_calls(df, schemas=schemas).collect()}
    assert got[1, "turn-0"].status == "linked" and got[1, "turn-0"].record == '{"arguments":{"prompt":"hi"},"id":"turn-0","name":"respond","result":"hello"}'
    assert got[2, "a"].problems == "$.x: not integer" and got[2, "a"].record.endswith('"result":"{\\"z\\":[1,\\"é\\"]}"}')
    assert (got[2, "c"].level, got[2, "b"].level, got[2, "p"].level, got[2, "q"].level) == (0, 1, -1, -1)
    assert got[2, "b"].problems == "$.y: over 1" and got[2, "c"].problems == "unknown tool nope"
    assert got[2, "zzz"].status == "orphan" and got[2, "zzz"].problems is None
    assert got[None, "turn-0"].problems == "$.prompt: too short" and len(got) == 8
    assert toolcalls.link_tool_calls(df.limit(0)).count() == 0


def test_neighbours_with_odd_vectors(spark):
    rng = np.random.default_rng(0)
    data = [(i, rng.standard_normal(8).tolist()) for i in range(60)]
    data += [(100, None), (101, [0.0] * 8), (102, [1.0, None] + [0.0] * 6), (103, [float("nan")] * 8), (104, [1.0, 2.0]), (105, [float("inf")] * 8), (0, data[0][1]), (None, data[1][1])]
    data += [(200 + i, data[20][1]) for i in range(30)]  # copies
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    x = {i: np.array(v) for i, v in dict(data[:60] + [(200 + i, data[20][1]) for i in range(30)]).items()}
    got = {}
    for r in ann.nearest(df, k=20, every=20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in x if i % 20 == 0}
    for q, found in got.items():
        want = sorted(((-float(x[q] @ x[j]), j) for j in x if j != q))[:20]
        assert [v for _, v, _ in sorted(found)] == [j for _, j in want]
    few = spark.createDataFrame([(20, [1.0, 2.0]), (3, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(few).collect()] == [(20, 1, 3, 4.0)]
    assert ann.nearest(few.limit(0)).count() == 0 and ann.nearest(few.limit(1)).count() == 0
