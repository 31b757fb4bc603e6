"""The kept text index against a search over all postings, its upkeep, and what it reads."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from cutframe.operators import search as se
from cutframe.operators import textindex
from cutframe.operators.textindex import TextIndex

QUERIES = [(1, "alpha beta"), (2, "rare"), (3, "alpha"), (4, "beta gamma alpha"), (5, "nowhere alpha"), (6, "!!"), (7, "Alpha ALPHA")]


def texts(seed, n):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(["alpha", "beta", "gamma", "delta", "rare"], [9, 5, 3, 8, 0.1], k=rng.randint(0, 30)))) for i in range(n)]


def whole(spark, docs, queries, k):
    index = se.postings(docs)
    found = se.keyword_search(index, index.groupBy("doc_id").agg(F.sum("tf").alias("n")), queries, k)
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("layout", [{}, {"buckets": 3, "span": 16, "shelf": 64}])
def test_search_equals_a_search_of_everything(spark, tmp_path, layout):
    docs = spark.createDataFrame([*texts(1, 400), (400, None), (401, "")], "doc_id long, text string")
    queries = spark.createDataFrame(QUERIES, "query_id int, query string")
    index = TextIndex(spark, str(tmp_path / "index"), **layout).build(docs)
    for k in (1, 5, 500):
        assert sorted(map(tuple, index.search(queries, k).collect())) == whole(spark, docs, queries, k)


def test_upkeep(spark, tmp_path):
    layout = {"buckets": 3, "span": 16, "shelf": 64}
    old = dict(texts(2, 300))
    index = TextIndex(spark, str(tmp_path / "index"), **layout).build(spark.createDataFrame(list(old.items()), "doc_id long, text string"))
    written = {str(p.relative_to(tmp_path)) for p in (tmp_path / "index" / "blocks").rglob("part-*")}
    changed = [(5, "rare rare beta"), (70, ""), (301, "alpha rare"), (None, "x")]
    gone = [(i,) for i in range(64, 128)] + [(9999,)]
    for _ in range(2):  # the second time changes nothing
        index.apply(spark.createDataFrame(gone, "doc_id long"), spark.createDataFrame(changed, "doc_id long, text string"))
        now = {i: t for i, t in old.items() if not 64 <= i < 128} | {i: t for i, t in changed if i is not None}
        docs = spark.createDataFrame(list(now.items()), "doc_id long, text string")
        queries = spark.createDataFrame(QUERIES, "query_id int, query string")
        assert sorted(map(tuple, index.postings().collect())) == sorted(map(tuple, se.postings(docs).collect()))
        assert sorted(map(tuple, index.search(queries, 7).collect())) == whole(spark, docs, queries, 7)
    same = {p for p in written if (tmp_path / p).exists()}
    assert same == {p for p in written if "shelf=2" in p or "shelf=3" in p}  # shelves that no change names keep their files
    assert index.apply(spark.createDataFrame([], "doc_id long"), spark.createDataFrame([], "doc_id long, text string")) is index


def test_only_the_terms_blocks_are_read_and_weak_ones_skipped(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(["alpha"] * (12 if i < 20 else 1) + rng.choices("abcdefghij", k=20))) for i in range(4000)]
    index = TextIndex(spark, str(tmp_path / "index"), buckets=8, span=16, shelf=1024).build(spark.createDataFrame(rows, "doc_id long, text string"))
    spans, hits = index.plan(spark.createDataFrame([(1, "alpha")], "query_id int, query string"), 5)
    told = spans.collect()
    assert len(told) == 250 and sum(r.opened for r in told) <= 8
    plan = hits._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket" in plan.split("PartitionFilters")[1][:60]
    files = index.blocks().filter(F.col("bucket") == 0).inputFiles()
    assert 0 < len(index._asked(spark.createDataFrame([(1, "alpha")], "query_id int, query string"))[1].select(F.input_file_name()).distinct().collect()) <= len(files)


def block_plans(monkeypatch, work):
    """The plans by which `work` writes blocks."""
    seen = []
    plain = textindex.overwrite_partitions

    def told(rows, path, *by, **options):
        if path.endswith("/blocks"):
            seen.append(rows._jdf.queryExecution().executedPlan().toString())
        plain(rows, path, *by, **options)

    monkeypatch.setattr(textindex, "overwrite_partitions", told)
    work()
    return seen


def shuffled(plan):
    """By what a plan's shuffles deal rows, without the columns' numbers."""
    return [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\(([^()]*)", plan)]


def test_building_shuffles_texts_and_no_postings(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame(texts(4, 200), "doc_id long, text string")
    (plan,) = block_plans(monkeypatch, lambda: TextIndex(spark, str(tmp_path / "index"), buckets=3, span=16, shelf=64).build(docs))
    assert "Exchange hashpartitioning(span" in plan
    assert not any(c in x for x in shuffled(plan) for c in ("term", "bucket", "doc_id"))


def test_a_change_shuffles_no_postings_and_search_adds_up_blocks(spark, tmp_path, monkeypatch):
    old = dict(texts(5, 200))
    index = TextIndex(spark, str(tmp_path / "index"), buckets=3, span=16, shelf=64).build(spark.createDataFrame(list(old.items()), "doc_id long, text string"))
    changed = [(i, f"alpha {t} rare") for i, t in texts(6, 200) if i % 5 == 2]
    monkeypatch.setattr(textindex, "SHELVES", 2, raising=False)  # more than one round
    plans = block_plans(monkeypatch, lambda: index.apply(spark.createDataFrame([(i,) for i in range(1, 200, 5)], "doc_id long"), spark.createDataFrame(changed, "doc_id long, text string")))
    assert plans and not any(c in x for plan in plans for x in shuffled(plan) for c in ("term", "bucket", "doc_id"))
    docs = spark.createDataFrame(list(({i: t for i, t in old.items() if i % 5 != 1} | dict(changed)).items()), "doc_id long, text string")
    queries = spark.createDataFrame(QUERIES, "query_id int, query string")
    assert index.blocks().filter("term = 'alpha'").groupBy("span").count().filter("count > 1").count() > 0
    for k in (3, 500):
        assert sorted(map(tuple, index.search(queries, k).collect())) == whole(spark, docs, queries, k)
    assert sorted(map(tuple, index.lengths().select("doc_id", "n").collect())) == sorted((i, len(t.split())) for i, t in docs.collect() if t)
