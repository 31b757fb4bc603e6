"""Phrase collocations against plain counting, quotient filters against what went in, and edge cases."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cutframe.llm import collocations as c
from cutframe.llm import queries as q
from cutframe.llm.common import ship_package

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def plain(rows, least=10, absorb=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(A_TO_Z)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {p for t, a in found.items() if len(t) == 3 for p in (t[:2], t[1:]) if 100 * a >= absorb * found[p]}
        told = []
        for p, a in found.items():
            if p not in gone:
                score, k = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                told.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(told)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def told(df):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def test_query(spark, sf_dir):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = plain(rows)
    assert len(want) > 100 and told(q.op13_collocations(spark, sf_dir)) == want


def test_many_small_shards_and_ranges(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(c, "SALTS", (3, 1))
    monkeypatch.setattr(c, "HELD_WORDS", 3000)
    monkeypatch.setattr(c, "RANGE_ENTRIES", 5000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(7)
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert told(c.collocations(docs, least=4, absorb=80, top=50)) == plain(rows, 4, 80, 50)


DOCS = "doc_id long, text string, lang string, phrase string, n int, rank string, grp string"


def odd(texts):
    return [(None, t, lang, "x", 1, "r", "g") for t, lang in texts]


def test_edges(spark):
    texts = [(None, "en"), ("", "en"), (" \t ", None), (".,;", "fr"), ("New York", None), ("new york. New York\tcity Ünï", "en"), ("a a a a a a a a a a a a", "en"), ("new york, city", "en")] + [("Ab cd\x0bEF gh", "en")] * 12 + [("NEW YORK CITY", "xx")] * 10
    df = spark.createDataFrame(odd(texts), DOCS)
    got = told(c.collocations(df))
    assert got == plain([(lang, t) for t, lang in texts]) and {g[0] for g in got} == {"en", "xx"}
    assert c.collocations(df.filter("false")).count() == 0
    assert c.collocations(df.limit(4)).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_very_long_texts(spark, monkeypatch):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in rng.zipf(1.3, 60_000) % 400]
    long = " ".join(w + ("." if i % 9 == 0 else "") for i, w in enumerate(words))
    one_piece, one_word = " ".join(words[:30_000]), "x" * 3_000_000
    texts = [long, one_piece, one_word + " y " + one_word, one_word]
    want = plain([("en", t) for t in texts])
    assert told(c.collocations(spark.createDataFrame(odd([(t, "en") for t in texts]), DOCS))) == want
    monkeypatch.setattr(c, "BLOCK_BYTES", 50)
    for t in texts[:2]:
        flat = [w for part in c.word_blocks(t.encode()) for w in part]
        assert b" ".join(flat).split(c.END) == b" ".join(w for part in _whole(t) for w in part).split(c.END)


def _whole(text):
    for piece in re.split(r"[.]", text):
        yield [w.encode() for w in piece.split()]
        yield [c.END]


@settings(deadline=None, max_examples=60)
@given(st.integers(1, 42), st.sampled_from([2, 3]), st.integers(0, 400), st.integers(0, 2**32))
def test_filters_lose_nothing(bits, n, size, seed):
    rng = np.random.default_rng(seed)
    words = [rng.integers(0, 1 << bits, size).astype(np.uint64) for _ in range(n)]
    counts = rng.integers(1, 5, size) ** rng.integers(0, 12, size)
    want = Counter()
    for key, k in zip(zip(*(w.tolist() for w in words), strict=True), counts.tolist(), strict=True):
        want[key] += k
    (left, right), half = c.packed(words, bits)
    left, right, counts = c.summed(*c.permuted(left, right, half), counts, half)
    left, right, counts, back = c.filter_entries(c.filter_bytes(left, right, counts, half))
    assert back == half
    got = c.unpacked(*c.permuted(left, right, half, back=True), n, bits)
    assert Counter(dict(zip(zip(*(w.tolist() for w in got), strict=True), counts.tolist(), strict=True))) == want
    order = list(zip(left.tolist(), right.tolist(), strict=True))
    assert order == sorted(set(order))


def test_scores_are_exact(spark):
    rows = [(10**15 - 1, 10**15, 10**15 + 7), (10, 10, 10), (333, 1000, 999), (9_999_999_999, 10**10, 10**12)]
    got = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", c._score("a", "l", "r").alias("s")).collect()
    assert all(r.s == 10**6 * r.a * r.a // (r.l * r.r) for r in got)


def test_sql_twin(spark, sf_dir):
    import duckdb

    with duckdb.connect(config={"threads": 4, "memory_limit": "4GB"}) as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
        assert sorted(db.sql(q.oracle_sql()["op13_collocations"]).fetchall()) == told(q.op13_collocations(spark, sf_dir))
    assert {k for n, k in q.op13_collocations(spark, sf_dir).dtypes if n not in ("lang", "phrase")} == {"bigint"}
