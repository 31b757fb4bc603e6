"""The language query against plain loops: counts of all labelled rows, bit classifiers, and every codeword's loss."""

from __future__ import annotations

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cutframe.llm import queries as q
from cutframe.llm.langid import DIMENSIONS, codewords, ngram_counts


def test_op3_against_loops(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    grams = {d.doc_id: {int(g): float(n) for g, n in enumerate(ngram_counts((d.text or "").encode(), DIMENSIONS)) if n} for d in docs}
    counts = defaultdict(lambda: defaultdict(float))
    for d in docs:
        if d.lang is not None and d.text is not None and zlib.crc32(str(d.doc_id).encode()) % 4 != 2:
            size = max(1.0, math.sqrt(sum(grams[d.doc_id].values())))
            for g, n in grams[d.doc_id].items():
                counts[d.lang][g] += n / size
    langs = sorted(counts)
    share = np.full((len(langs), DIMENSIONS), 0.01)
    for i, lang in enumerate(langs):
        for g, n in counts[lang].items():
            share[i, g] += n
        share[i] /= share[i].sum()
    codes = codewords(len(langs), 15)
    bits = range(codes.shape[1])
    weight = [np.log(share[codes[:, b] > 0].mean(axis=0) / share[codes[:, b] < 0].mean(axis=0)) for b in bits]
    trust = [max(0.05, math.tanh(min(float(share[i] @ weight[b]) * codes[i, b] for i in range(len(langs))))) for b in bits]
    trust = [t * len(trust) / sum(trust) for t in trust]
    rows = {r.doc_id: r for r in q.op3_language_id(spark, sf_dir).collect()}
    assert set(rows) == set(grams)
    for d in docs:
        got = rows[d.doc_id]
        if not any(c.isalpha() for c in d.text or ""):
            assert (got.lang_pred, got.score) == ("und", 0.0)
            continue
        root = math.sqrt(sum(grams[d.doc_id].values()) or 1.0)
        margin = [max(-30.0, min(30.0, sum(n * weight[b][g] for g, n in grams[d.doc_id].items()) / root)) for b in bits]
        loss = [sum(trust[b] * math.log1p(math.exp(-codes[i, b] * margin[b])) for b in bits) for i in range(len(langs))]
        least = min(loss)
        assert loss[langs.index(got.lang_pred)] == pytest.approx(least, abs=1e-6)
        assert got.score == pytest.approx(1 / sum(math.exp(least - x) for x in loss), abs=1e-6)
