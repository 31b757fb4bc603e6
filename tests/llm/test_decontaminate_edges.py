"""Decontamination at the rules' own edges, against the longest common subsequence of every window of the item's length."""

from __future__ import annotations

import math
import random

import pytest

from cutframe.llm import decontaminate as dc


def corpus(seed: int = 11):
    """Items of 3 to 70 words and documents that hold them whole, at the strong ratio, or at the weak one with the answer kept."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.choice((1, 2, 3)))) for _ in range(4000)]
    weights = [1 / (r + 3) for r in range(len(words))]
    text = lambda n: rng.choices(words, weights, k=n)
    items, docs = {}, {}
    for i, n in enumerate((3, 4, 5, 7, 8, 10, 13, 16, 21, 22, 24, 30, 32, 40, 45, 46, 50, 64, 70)):
        question, answer = text(n - max(1, n // 4)), text(max(1, n // 4))
        items[i] = " ".join(question) + (". " if n > 7 else " ") + " ".join(answer) + "."
        for keep, whole_answer in ((1.0, True), (0.7, False), (0.5, True), (0.4, True)):
            item = question + answer
            places = range(len(question)) if whole_answer else range(n)
            for at in rng.sample(places, min(len(places), n - math.ceil(keep * n - 1e-9))):
                item[at] = f"zz{rng.randrange(10**6)}"
            docs[len(docs)] = " ".join(text(rng.randrange(90)) + item + text(rng.randrange(90)))
    for _ in range(40):
        docs[len(docs)] = " ".join(text(200))
    return items, docs


def accepted(item: dc.Item, words: list[str]) -> bool:
    n, rules = len(item.words), dc.Rules()
    for at in range(max(1, len(words) - n + 1)):
        part = words[at : at + n]
        ratio = dc.common_subsequence(item.words, part) / n
        if ratio == 1 or n >= rules.least_words and (ratio >= rules.strong or ratio >= rules.weak and dc.common_subsequence(item.answer, part) == len(item.answer)):
            return True
    return False


@pytest.fixture(scope="module")
def planted():
    return corpus()


def test_nothing_that_the_rules_accept_is_lost(spark, planted):
    texts, docs = planted
    items = dc.items_of(list(texts.items()))
    want = {(d, item.item_id) for d, t in docs.items() for item in items if accepted(item, dc.plain_words(t))}
    assert len(want) > 45
    rows = dc.leaks(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(list(texts.items()), "item_id long, text string")).collect()
    assert want - {(r.doc_id, r.item_id) for r in rows} == set()
    for r in rows:
        item, part = items[r.item_id], dc.plain_words(docs[r.doc_id])[r.first_word : r.end_word]
        assert r.ratio == dc.common_subsequence(item.words, part) / len(item.words) and -1.001 <= r.cosine <= 1.001
        assert r.ratio == 1 if len(item.words) < 8 else r.ratio >= 0.7 or r.ratio >= 0.5 and r.answer
    kept = dc.without_leaks(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(list(texts.items()), "item_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == set(docs) - {r.doc_id for r in rows}


def test_repeated_words_and_many_items(spark):
    """Words that stand more than once count more than once; items beyond one tile."""
    items = [(i, f"q{i} r{i} s{i} t{i} u{i} v{i} w{i} x{i} y{i} z{i}") for i in range(300)] + [(999, "no no no no no no no yes maybe so")]
    docs = [(0, "a b c no no no no no no no d e f"), (1, "b " * 50 + "q299 r299 s299 t299 u299 v299 w299 other other other"), (2, "no no no d e f")]
    rows = dc.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(0, 999), (1, 299)}


def test_very_long_document():
    """Found in each part of a document that goes in overlapping parts."""
    import numpy as np

    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    filler = [f"f{i % 700}" for i in range(40_000)]
    space = dc.LatentSpace(np.random.default_rng(0).standard_normal((dc.DIMENSIONS, 8)).astype(np.float32))
    search = dc._Search(space, dc.items_of([(1, item)]), dc.Rules())
    for at in (0, 32_760, 32_768, 39_000, 40_000):
        text = " ".join(filler[:at] + item.split() + filler[at:])
        found = search.batch([dc.WordIds(dc.DIMENSIONS).of(text.split())], lambda i, text=text: text)
        assert [x[2] for x in found[0]] == [1.0] and found[0][0][4] <= at < at + 10 <= found[0][0][5]


def test_short_items_and_documents_dealt_in_any_way(spark):
    """Items of 1 to 8 words in documents of any length: short ones must stand word after word; one partition or fifty give the same rows."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    items = {n: " ".join(rng.sample(words, n)) for n in range(1, 9)}
    docs = {}
    for n, text in items.items():
        for lead in (0, 1, 5, 40):
            docs[len(docs)] = " ".join([*rng.choices(words, k=lead), text, *rng.choices(words, k=lead)])
        if n > 1:
            docs[len(docs)] = " between ".join(text.split())
    docs[len(docs)] = " ".join(rng.choices(words, k=400))
    want = set()
    for d, t in docs.items():
        for i, x in items.items():
            if f" {x} " in f" {t} " and i < 8:
                want.add((d, i))
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    results = [sorted(tuple(r) for r in dc.leaks(frame.repartition(parts), benchmark).collect()) for parts in (1, 50)]
    plain = [[(*r[:2], *r[3:]) for r in rows] for rows in results]  # the cosine's last digits depend on the order of sums
    assert plain[0] == plain[1]
    assert {(r[0], r[1]) for r in results[0] if r[1] < 8} == want
    assert {(d, 8) for d, t in docs.items() if f" {items[8]} " in f" {t} "} <= {(r[0], r[1]) for r in results[0]}
