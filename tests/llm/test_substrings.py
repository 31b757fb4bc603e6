from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from cutframe.llm import substrings


def brute(texts: list[str | None], window: int) -> list[tuple[int, int, str]]:
    docs = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(d[i : i + window]) for d in docs for i in range(len(d) - window + 1))
    out = []
    for d in docs:
        gone = set()
        for i in range(len(d) - window + 1):
            if seen[tuple(d[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(d) if i not in gone)
        out.append((len(d), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def corpus() -> list[str | None]:
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefghijkl") + str(rng.randrange(60))
    passage = [word() for _ in range(50)]
    texts: list[str | None] = [None, "", "  ", "one two"]
    for i in range(60):
        body = [word() for _ in range(rng.randrange(5, 120))]
        if i % 3 == 0:
            at = rng.randrange(len(body))
            a = rng.randrange(0, 10)
            body[at:at] = passage[a : a + rng.randrange(30, 50)]
        if i % 7 == 0:
            body += body[:40]
        texts.append((" " if i % 2 else "\n\t").join(body))
    texts += [texts[10], texts[10], " ".join(["x"] * 90), " ".join(["p", "q"] * 50), "é ü " * 40]
    base = [word() for _ in range(150)]
    for _ in range(25):  # near copies
        copy = list(base)
        for _ in range(3):
            copy[rng.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize(("window", "hot"), [(35, 4000), (35, 2), (12, 4000), (5, 3)])
def test_equals_brute_force(spark, window, hot):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    rows = substrings.remove_repeated_spans(docs, min_words=window, hot=hot, shard_words=3000).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept_sha256) for r in rows] == brute(texts, window)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.remove_repeated_spans(docs).count() == 0


def test_automaton_counts_places():
    a = substrings.SuffixAutomaton()
    for text in ([1, 2, 3, 1, 2, 3], [2, 3, 1]):
        last = 0
        for x in text:
            last = a.extend(last, x)
            a.weight[last] += 1
    a.settle()
    assert list(a.places([1, 2, 3, 1], 2)) == [0, 2, 3, 2]
    assert list(a.places([9, 3, 1, 2], 2)) == [0, 0, 2, 2]
