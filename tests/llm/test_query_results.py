"""Each registered query against a brute-force version over sf0.001."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cutframe.llm import queries as q
from cutframe.llm.secrets import KINDS

from .test_substrings import brute


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()


def test_op1_recall(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    got = defaultdict(dict)
    for r in q.op1_nearest_neighbours(spark, sf_dir).collect():
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    asked = [i for i in ids if i % 20 == 0]
    assert set(got) == set(asked)
    hit = total = 0
    for i in asked:
        s = x @ x[ids == i][0]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:20]
        found = [got[i][r] for r in sorted(got[i])]
        assert sorted(got[i]) == list(range(1, 21))
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        assert all(abs(score - s[ids == v][0]) < 1e-9 for v, score in found)
        hit += len({ids[j] for j in order} & {v for v, _ in found})
        total += 20
    assert hit / total >= 0.9


def test_op2_counts(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(q.tokenizer_path())
    want = {d.doc_id: len(t.encode(d.text or "", add_special_tokens=False).ids) for d in docs}
    rows = q.op2_token_counts(spark, sf_dir).collect()
    assert len(rows) == len(want) and {r.doc_id: r.n_tokens for r in rows} == want


def test_op3_held_out_accuracy(spark, sf_dir, docs):
    lang = {d.doc_id: d.lang for d in docs}
    rows = q.op3_language_id(spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_op4(spark, sf_dir, docs):
    rows = q.op4_substring_dedup(spark, sf_dir).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept_sha256) for r in rows] == brute([d.text for d in docs], 35)


def classes_by_brute_force(texts: dict[int, str | None], threshold: float = 0.8, counted: bool = True) -> dict[int, int]:
    """counted: the n-th time of a shingle is an element of its own, so that sets of elements weigh shingles by their number."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().split()
        if w:
            n = min(5, len(w))
            times = Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
            sets[i] = {(g, j) for g, m in times.items() for j in range(m if counted else 1)}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common >= threshold * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in texts}


def test_op5(spark, sf_dir, docs):
    want = classes_by_brute_force({d.doc_id: d.text for d in docs})
    assert {r.doc_id: r.class_id for r in q.op5_minhash_neardup(spark, sf_dir).collect()} == want


def test_op8(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(q.tokenizer_path())
    ids = {d.doc_id: [*t.encode(d.text or "", add_special_tokens=False).ids, 1] for d in docs}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in q.op8_packing(spark, sf_dir).collect():
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert len(piece) == r.length and zlib.crc32(piece.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(ids)
    for pieces, whole in ((by_doc, lambda k: len(ids[k])), (by_sequence, lambda k: None)):
        for k, parts in pieces.items():
            end = 0
            for start, length in sorted(parts):
                assert start == end
                end += length
            assert whole(k) in (None, end)
    used = [sum(n for _, n in parts) for parts in by_sequence.values()]
    assert max(used) <= 2048
    assert len(used) <= sum(used) / 2048 * 1.03 + 1


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_op9(spark, sf_dir, docs):
    rows = {r.doc_id: r for r in q.op9_secret_scan(spark, sf_dir).collect()}
    for d in docs:
        listed = [f"{KINDS[k]}:{a}:{b}" for a, k, b in base_spans(d.text)]
        assert rows[d.doc_id].base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(rows[d.doc_id].spans.split(",")) | {""}


def test_op10(spark, sf_dir, docs):
    items = {r.item_id: " ".join(r.text.split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    want = {(d.doc_id, i) for d in docs for i, t in items.items() if t in " ".join((d.text or "").split())}
    assert {(r.doc_id, r.item_id) for r in q.op10_decontamination(spark, sf_dir).collect()} == want
