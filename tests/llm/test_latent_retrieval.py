"""A passage whose words stand in another order is found by its cosine alone, so not when the latent space is noise."""

from __future__ import annotations

import random

import numpy as np

from cutframe.llm import decontaminate as dc


def test_reordered_passage():
    rng = random.Random(5)
    words = [f"w{i}x" for i in range(900)]
    items = [(i, " ".join(rng.sample(words, 26)) + ". " + " ".join(rng.sample(words, 6)) + ".") for i in range(20)]
    item = items[7][1].split()
    moved = item[20:26] + item[13:20] + item[6:13] + item[:6] + item[26:]
    text = " ".join([*rng.choices(words, k=96), *moved, *rng.choices(words, k=70)])
    vectors = np.random.default_rng(1).standard_normal((dc.LATENT, 64)).astype(np.float32)
    found = []
    for space in (vectors, np.zeros_like(vectors)):
        search = dc._Search(dc.LatentSpace(space), dc.items_of(items), dc.Rules())
        hits = search.batch([dc.WordIds(dc.DIMENSIONS).of(text.split())], lambda i: text)
        found.append([x[0] for x in hits.get(0, [])])
        assert all(x[2] < 0.5 and x[3] for x in hits.get(0, []))
    assert found == [[7], []]
    other = " ".join(rng.choices(words, k=300))
    search = dc._Search(dc.LatentSpace(vectors), dc.items_of(items), dc.Rules())
    assert search.batch([dc.WordIds(dc.DIMENSIONS).of(other.split()), np.zeros(0, np.int64)], lambda i: other) == {}
