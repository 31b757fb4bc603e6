"""The pipeline's rows against a brute-force version of its stages."""

from __future__ import annotations

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from cutframe.llm.queries import tokenizer_path  # noqa: E402

from .test_query_results import base_spans, classes_by_brute_force  # noqa: E402


def test_run(spark, sf_dir):
    from tokenizers import Tokenizer

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    texts = {i: t for i, t in docs.items() if t and any(c.isalpha() for c in t)}
    classes = classes_by_brute_force(texts)
    kept = {i: t for i, t in texts.items() if classes[i] == i and not any(x in " ".join(t.split()) for x in items)}
    t = Tokenizer.from_file(tokenizer_path())
    got = {}
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        got.setdefault(r.doc_id, {})[r.start] = np.frombuffer(r.ids, "<u4").tolist()
    assert set(got) == set(kept)
    for i, text in kept.items():
        clean, at = [], 0
        for start, _, end in base_spans(text):
            if start >= at:
                clean += [text[at:start], "[REDACTED]"]
                at = end
            else:
                at = max(at, end)
        ids = [x for start in sorted(got[i]) for x in got[i][start]]
        assert ids == [*t.encode("".join(clean) + text[at:], add_special_tokens=False).ids, 1]


def test_stages_keep_columns_and_take_odd_rows(spark, sf_dir):
    rows = [(1, None, None, None, None), (None, "ein Haus und ein Hund", "de", "s", 3), (3, "", "en", "s", 0), (3, "the dog and the house", "en", "s", 5), (3, "the dog and the house", "en", "s", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for frame, n in ((spark.createDataFrame(rows, schema), 2), (spark.createDataFrame([], schema), 0)):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.columns == frame.columns
        assert docs.count() == n
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == n


def test_language_stage_rejects_what_it_cannot_tell(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = ["Это предложение написано на языке, которого в таблице нет. " * k for k in (1, 30)] + ["これは表にない言語で書かれた文です。" * 9, "12 34 %%", None, ""]
    more = spark.createDataFrame([(-1 - i, t, None, "s", 0) for i, t in enumerate(odd)], "doc_id long, text string, lang string, source string, n_chars long").select(*docs.columns)
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs.unionByName(more), sf_dir).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)}
