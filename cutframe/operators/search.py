"""Library search and management."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"


def postings(docs: DataFrame) -> DataFrame:
    """The inverted index of docs (doc_id, text): term, doc_id, tf. Documents without a word have no row."""
    terms = docs.select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))).alias("term"))
    return terms.groupBy("term", "doc_id").agg(F.count("*").alias("tf"))


def apply_index_delta(index: DataFrame, gone: DataFrame, changed: DataFrame) -> DataFrame:
    """The index without documents that went or changed (doc_id), and with the postings of the changed texts."""
    old = gone.select("doc_id").unionByName(changed.select("doc_id")).distinct()
    return index.join(old, "doc_id", "left_anti").select("term", "doc_id", "tf").unionByName(postings(changed))


def keyword_search(index: DataFrame, lengths: DataFrame, queries: DataFrame, k: int, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """query_id, rank, doc_id, score: documents that hold every query word, by BM25, ties by doc_id.

    index(term, doc_id, tf), lengths(doc_id, n) of all documents, queries(query_id, query).
    """
    words = queries.select("query_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("query"), F.lit(WORD), F.lit(0)))).alias("term"))
    need = words.groupBy("query_id").agg(F.count("*").alias("need"))
    df = index.join(words.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
    corpus = lengths.agg(F.count("*").alias("docs"), F.avg("n").alias("avgdl"))
    hits = words.join(index, "term").join(df, "term").join(lengths, "doc_id").crossJoin(F.broadcast(corpus))
    idf = F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("n") / F.col("avgdl")))
    g = hits.groupBy("query_id", "doc_id").agg(F.round(F.sum(weight), 6).alias("score"), F.count("*").alias("have"))
    full = g.join(need, "query_id").filter("have = need")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return full.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def like_search(docs: DataFrame, text: str, k: int) -> DataFrame:
    """doc_id of the first k documents, by id, whose text holds the string, whatever its case."""
    return docs.filter(F.lower("text").contains(text.lower())).select("doc_id").orderBy("doc_id").limit(k)


#: Bytes of queries that are sent to every task at a time; more go in several passes over the vectors.
QUERY_BYTES = 32 << 20


def _query_blocks(queries: DataFrame) -> Iterator[tuple[list, np.ndarray]]:
    """Ids and vectors of the queries, at most QUERY_BYTES at a time. Queries without a vector have no answer."""
    rows = queries.select("query_id", F.col("qv").cast("array<double>").alias("qv")).filter("qv is not null and size(qv) > 0 and not exists(qv, x -> x is null)")
    told = rows.agg(F.sum(F.size("qv") * 8 + 64).alias("bytes")).first()
    passes = -(-(told.bytes or 0) // QUERY_BYTES)
    for p in range(passes):
        some = (rows if passes == 1 else rows.filter(F.pmod(F.xxhash64("query_id"), F.lit(passes)) == p)).collect()
        for width in sorted({len(r.qv) for r in some}):
            own = [r for r in some if len(r.qv) == width]
            yield [r.query_id for r in own], np.array([r.qv for r in own], dtype=np.float64)


#: Scores that a task holds at a time: so many queries meet one batch of vectors.
CELLS = 1 << 20


def _best(place: np.ndarray, own: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k greatest of each place's scores, ties by id; a score that is no number is the greatest, as in SQL."""
    order = np.lexsort((own, -np.where(np.isnan(score), np.inf, score), place))
    place = place[order]
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if place.size else place
    keep = np.arange(place.size) - np.repeat(first, np.diff(np.r_[first, place.size])) < k
    return place[keep], own[order][keep], score[order][keep]


def _nearest(ids: list, vectors: np.ndarray, k: int):
    """Each task's k best vectors of every query: batches of vectors against some queries at a time, with the best so far kept."""
    width = vectors.shape[1]
    unit = vectors / (np.sqrt((vectors * vectors).sum(axis=1)) + 1e-9)[:, None]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        least = np.full(len(ids), -np.inf)  # a query's k-th score so far
        for batch in batches:
            x = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            own = batch.column("vec_id").to_numpy()
            norm = np.sqrt((x * x).sum(axis=1)) + 1e-9
            found = [best]
            some = max(1, CELLS // max(1, own.size))
            for at in range(0, len(ids), some):
                score = np.round((unit[at : at + some] @ x.T) / norm, 6)
                key = np.where(np.isnan(score), np.inf, score)
                floor = least[at : at + some]
                if own.size > k:  # all that tie with the k-th stay, the ids decide
                    floor = np.maximum(floor, np.partition(key, own.size - k, axis=1)[:, own.size - k])
                q, c = np.nonzero(key >= floor[:, None])
                found.append(_best(q + at, own[c], score[q, c], k))
            best = _best(*(np.concatenate(part) for part in zip(*found, strict=True)), k)
            count = np.bincount(best[0], minlength=len(ids))
            last = np.cumsum(count) - 1
            full = count == k
            least[full] = np.where(np.isnan(best[2]), np.inf, best[2])[last[full]]
        if best[0].size:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in best], names=["place", "vec_id", "score"])

    return work


def semantic_search(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k greatest normalised dot products, ties by vec_id; vectors of another length, or with nulls in them, are skipped.

    Queries (query_id, qv) go to the tasks in blocks of a checked size, one pass over the vectors for each; a task gives k rows a query at most.
    """
    spark = vectors.sparkSession
    kind = queries.schema["query_id"].dataType.simpleString()
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).filter("vec_id is not null and embedding is not null and not exists(embedding, x -> x is null)")
    found = spark.createDataFrame([], f"query_id {kind}, vec_id bigint, score double")
    for ids, block in _query_blocks(queries):
        names = spark.createDataFrame(list(enumerate(ids)), f"place bigint, query_id {kind}")
        best = rows.filter(F.size("embedding") == block.shape[1]).mapInArrow(_nearest(ids, block, k), "place bigint, vec_id bigint, score double")
        rank = F.row_number().over(Window.partitionBy("place").orderBy(F.desc("score"), "vec_id"))
        found = found.unionAll(best.withColumn("rank", rank).filter(F.col("rank") <= k).join(names, "place").select("query_id", "vec_id", "score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def transcript_search(segments: DataFrame, clips: DataFrame, queries: DataFrame, k: int, source: str | None = None) -> DataFrame:
    """Semantic search over transcript segments (vec_id, clip_id, source, embedding) with the clip's path; filters come before the search."""
    rows = segments if source is None else segments.filter(F.col("source") == source)
    found = semantic_search(rows.select("vec_id", "embedding"), queries, k)
    return found.join(rows.select("vec_id", "clip_id", "source"), "vec_id").join(clips.select("clip_id", "path"), "clip_id")


def embed_worklist(clips: DataFrame, embedded: DataFrame, model: str, batch: int = 32) -> DataFrame:
    """clip_id, batch: clips with a text but no vector of the model, in batches of `batch` by id.

    Batch numbers are dealt within ranges of ids, so that no single task numbers all clips.
    """
    todo = clips.filter(F.trim("text") != "").join(embedded.filter(F.col("model") == model), "clip_id", "left_anti").select("clip_id")
    shelf = F.floor(F.col("clip_id") / 100000).cast("bigint")
    n = F.row_number().over(Window.partitionBy(shelf).orderBy("clip_id")) - 1
    return todo.select("clip_id", shelf.alias("shelf"), F.floor(n / batch).cast("bigint").alias("batch"))


def add_tags(clips: DataFrame, matches, tags: list[str]) -> DataFrame:
    """New tags behind the old ones of matching clips, each once, in order. clips(clip_id, tags: space-separated)."""
    old = F.filter(F.split(F.coalesce("tags", F.lit("")), r"\s+"), lambda t: t != "")
    merged = F.array_join(F.array_distinct(F.concat(old, F.array(*(F.lit(t) for t in tags)))), " ")
    return clips.withColumn("tags", F.when(matches, merged).otherwise(F.col("tags")))


def remove_clips(pattern: str, clips: DataFrame, *children: DataFrame) -> list[DataFrame]:
    """clips and child tables without the clips whose path matches the pattern."""
    gone = clips.filter(F.col("path").rlike(pattern)).select("clip_id")
    return [t.join(gone, "clip_id", "left_anti") for t in (clips, *children)]


def library_status(clips: DataFrame, segments: DataFrame, vectors: DataFrame) -> DataFrame:
    """what, name, n: clips and their total size, segments by source, vectors by model."""
    total = clips.agg(F.count("*").alias("clips"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).select(F.lit("library").alias("what"), F.expr("stack(2, 'clips', clips, 'size', size) as (name, n)"))
    seg = segments.groupBy(F.col("source").alias("name")).agg(F.count("*").alias("n")).select(F.lit("segments").alias("what"), "name", "n")
    vec = vectors.groupBy(F.col("model").alias("name")).agg(F.count("*").alias("n")).select(F.lit("vectors").alias("what"), "name", "n")
    return total.unionByName(seg).unionByName(vec)


def pipeline_snapshot(clips: DataFrame, **stages: DataFrame) -> DataFrame:
    """clip_id with one count per named stage table, 0 where it has none."""
    out = clips.select("clip_id")
    for name, rows in stages.items():
        out = out.join(rows.groupBy("clip_id").agg(F.count("*").alias(name)), "clip_id", "left")
    return out.fillna(0, list(stages))


def latest_jobs(jobs: DataFrame, k: int = 25) -> DataFrame:
    return jobs.orderBy(F.desc("at"), F.desc("job_id")).limit(k)
