"""Codewords of any number of languages lie apart, and many languages are told from each other."""

from __future__ import annotations

import random

import pytest

from cutframe.llm import langid
from cutframe.llm.common import ship_package


@pytest.mark.parametrize("languages", [*range(2, 51), 200])
def test_no_two_codewords_are_near(languages):
    codes = langid.codewords(languages)
    apart = [(codes[i] != codes[j]).sum() for i in range(languages) for j in range(i)]
    assert min(apart) >= (3 if languages > 4 else 1)
    assert len({tuple(c * c[0]) for c in codes.T}) == codes.shape[1] and (abs(codes.sum(axis=0)) < languages).all()


def test_eight_languages(spark):
    ship_package(spark)
    rng = random.Random(8)
    words = {f"l{i}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(60)] for i in range(8)}
    texts = [(lang, " ".join(rng.choices(own, k=80))) for lang, own in words.items() for _ in range(30)]
    docs = spark.createDataFrame(texts, "lang string, text string")
    out = langid.identify(docs, langid.fit(docs)).collect()
    assert all(r.lang_pred == r.lang and not r.ambiguous for r in out)
