"""Random strings of one letter case are spans; words, dates and paths of one case aren't."""

from __future__ import annotations

import random
import re
import string

import pytest

from cutframe.llm import secrets

LOWER, UPPER = string.ascii_lowercase + string.digits, string.ascii_uppercase + "234567"


def parted(s: str) -> str:
    return "-".join(s[i : i + 6] for i in range(0, len(s), 6))


@pytest.mark.parametrize(("alphabet", "length", "shape"), [(LOWER, 20, str), (LOWER, 32, str), (LOWER, 30, parted), (UPPER, 20, str), (UPPER, 52, str), (UPPER, 32, lambda s: s + "===="), ("0123456789abcdef", 30, parted)])
def test_random_tokens_are_found(spark, alphabet, length, shape):
    rng = random.Random(9)
    words = [shape("".join(rng.choice(alphabet) for _ in range(length))) for _ in range(300)]
    rows = secrets.scan(spark.createDataFrame([(i, f"see {w} there") for i, w in enumerate(words)], "doc_id long, text string")).collect()
    hits = sum(f"entropy_single:4:{4 + len(words[r.doc_id])}" in r.spans.split(",") for r in rows)
    # the allow-list takes tokens where letters and digits meet less than twice
    due = sum(len(re.findall(secrets.MEET, w)) >= secrets.LEAST_MEETS for w in words)
    assert due >= 0.9 * len(words) and due >= hits >= 0.97 * due, (hits, due)


def test_ordinary_strings_stay(spark):
    words = ["how-to-plant-tomatoes-2024-05-12", "blog/2023/11/27/some-long-article-name", "products/item123-blue-cotton-shirt", "MAX_BUFFER_SIZE_IN_BYTES_1024", "0123456789abcdefghijklmnopqrstuvwxyz", "aaaaaaaaaaaaaaaaaaaa1a1a1a1a", "release-notes-version-2-10-0-final", "2024-05-12t10-30-00z-00-00"]
    assert [r.spans for r in secrets.scan(spark.createDataFrame([(i, w) for i, w in enumerate(words)], "doc_id long, text string")).collect()] == [""] * len(words)


def test_redacted(spark):
    text = "key q7w3k9z2m5x8c1v6b4n0p2r7 end"
    assert [r.text for r in secrets.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()] == ["key [REDACTED] end"]
