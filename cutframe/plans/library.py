"""LIB and SRC rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import search as se
from ..operators import timeline as tl
from ..operators.textindex import TextIndex
from ..sources import artifacts, files
from ..sources import catalog as ct
from ..sources import views as v
from . import query
from .timeline import REEL, r

TERMS = "ps AS (SELECT term, clip_id AS doc_id, count(*) AS tf FROM (SELECT clip_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM v_clips) GROUP BY 1, 2)"


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return v.v_clips(spark, sf).select(F.col("clip_id").alias("doc_id"), "text")


def kept_index(spark: SparkSession, sf: str) -> TextIndex:
    """The index of the documents as their files are now: made once, then opened by every later query and session."""
    path = f"{files.shared_folder(spark)}/cutframe-text-index-{files.fingerprint(spark, f'{sf}/documents.parquet')}"
    if not files.exists(spark, path):
        fresh = files.scratch(spark, "text-index")
        TextIndex(spark, fresh).build(docs(spark, sf))
        if not files.move(spark, fresh, path):  # another session was faster
            files.remove(spark, fresh)
    return TextIndex(spark, path)


@query("lib03_text_index", "v_clips", f", {TERMS} SELECT doc_id, count(*) AS terms, sum(tf)::BIGINT AS words FROM ps GROUP BY 1")
def lib03(spark: SparkSession, sf: str) -> DataFrame:
    return kept_index(spark, sf).postings().groupBy("doc_id").agg(F.count("*").alias("terms"), F.sum("tf").alias("words"))


@query("lib03_index_delta", "v_clips", f", {TERMS} SELECT doc_id, count(*) AS terms FROM ps WHERE doc_id % 5 <> 1 GROUP BY 1")
def lib03b(spark: SparkSession, sf: str) -> DataFrame:
    d = docs(spark, sf)
    old = d.withColumn("text", F.when(F.col("doc_id") % 5 == 2, F.lit("old words")).otherwise(F.col("text")))
    index = TextIndex(spark, files.scratch(spark, "text-index")).build(old).apply(d.filter("doc_id % 5 = 1").select("doc_id"), d.filter("doc_id % 5 = 2"))
    return index.postings().groupBy("doc_id").agg(F.count("*").alias("terms"))


QUERIES = ((1, "the of"), (2, "er thing"), (3, "que de la"), (4, "nosuchwordhere the"))


@query("lib01_keyword_search", "v_clips", f""", {TERMS}, q(query_id, term) AS (VALUES (1, 'the'), (1, 'of'), (2, 'er'), (2, 'thing'), (3, 'que'), (3, 'de'), (3, 'la'), (4, 'nosuchwordhere'), (4, 'the')),
ln AS (SELECT doc_id, sum(tf) AS n FROM ps GROUP BY 1), cp AS (SELECT count(*) AS nn, avg(n) AS av FROM ln), df AS (SELECT term, count(*) AS df FROM ps GROUP BY 1), nd AS (SELECT query_id, count(*) AS need FROM q GROUP BY 1),
h AS (SELECT query_id, p.doc_id, round(sum(ln(1 + (nn - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * ln.n / av))), 6) AS score, count(*) AS have FROM q JOIN ps p USING (term) JOIN df USING (term) JOIN ln ON ln.doc_id = p.doc_id, cp GROUP BY 1, 2)
SELECT query_id, rank, doc_id, score FROM (SELECT h.query_id, row_number() OVER (PARTITION BY h.query_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM h JOIN nd USING (query_id) WHERE have = need) WHERE rank <= 20""")
def lib01(spark: SparkSession, sf: str) -> DataFrame:
    return kept_index(spark, sf).search(spark.createDataFrame(QUERIES, "query_id int, query string"), 20)


@query("lib02_like_search", "v_clips", "SELECT clip_id AS doc_id FROM v_clips WHERE contains(lower(text), 'than ') ORDER BY 1 LIMIT 50")
def lib02(spark: SparkSession, sf: str) -> DataFrame:
    return se.like_search(docs(spark, sf), "Than ", 50)


COSINE = "qs AS (SELECT vec_id AS query_id, embedding AS qv FROM embeddings WHERE vec_id % 100 = 0), sc AS (SELECT q.query_id, e.vec_id, e.label, round(list_sum(list_transform(list_zip(e.embedding, q.qv), lambda z: z[1]::DOUBLE * z[2]::DOUBLE)) / ((sqrt(list_sum(list_transform(e.embedding, lambda x: x::DOUBLE * x::DOUBLE))) + 1e-9) * (sqrt(list_sum(list_transform(q.qv, lambda x: x::DOUBLE * x::DOUBLE))) + 1e-9)), 6) AS score FROM embeddings e, qs q)"


def _queries(spark: SparkSession, sf: str) -> DataFrame:
    e = v.table(spark, sf, "embeddings")
    return e.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qv"))


@query("lib04_semantic_search", "", f"WITH {COSINE} SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM sc) WHERE rank <= 10")
def lib04(spark: SparkSession, sf: str) -> DataFrame:
    return se.semantic_search(v.table(spark, sf, "embeddings").select("vec_id", "embedding"), _queries(spark, sf), 10)


@query("lib05_transcript_search", "v_clips", f", {COSINE} SELECT t.*, c.path FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score, vec_id AS clip_id, 's' || (label % 3) AS source FROM sc WHERE label % 3 = 1) t JOIN v_clips c USING (clip_id) WHERE rank <= 10")
def lib05(spark: SparkSession, sf: str) -> DataFrame:
    s = v.table(spark, sf, "embeddings").select("vec_id", F.col("vec_id").alias("clip_id"), F.concat(F.lit("s"), F.col("label") % 3).alias("source"), "embedding")
    return se.transcript_search(s, v.v_clips(spark, sf), _queries(spark, sf), 10, source="s1")


@query("lib06_embed_worklist", "v_clips", "SELECT clip_id, clip_id // 100000 AS shelf, (row_number() OVER (PARTITION BY clip_id // 100000 ORDER BY clip_id) - 1) // 32 AS batch FROM v_clips c WHERE trim(text) <> '' AND NOT EXISTS (SELECT 1 FROM embeddings e WHERE e.vec_id = c.clip_id AND e.label % 2 = 0)")
def lib06(spark: SparkSession, sf: str) -> DataFrame:
    done = v.table(spark, sf, "embeddings").select(F.col("vec_id").alias("clip_id"), F.concat(F.lit("m"), F.col("label") % 2).alias("model"))
    return se.embed_worklist(v.v_clips(spark, sf), done, "m0")


@query("lib07_add_tags", "v_clips", "SELECT clip_id, CASE WHEN dir = 'src3' THEN CASE WHEN lang = 'en' THEN 'en night' ELSE lang || ' night en' END ELSE lang || ' night' END AS tags FROM v_clips")
def lib07(spark: SparkSession, sf: str) -> DataFrame:
    c = v.v_clips(spark, sf).select("clip_id", "dir", F.concat("lang", F.lit(" night")).alias("tags"))
    return se.add_tags(c, F.col("dir") == "src3", ["night", "en"]).select("clip_id", "tags")


@query("lib08_remove_clips", "v_clips v_transcript", "SELECT 'clips' AS what, clip_id FROM v_clips WHERE NOT regexp_matches(path, '^src1/') UNION ALL SELECT 'transcript', clip_id FROM v_transcript WHERE clip_id NOT IN (SELECT clip_id FROM v_clips WHERE regexp_matches(path, '^src1/'))")
def lib08(spark: SparkSession, sf: str) -> DataFrame:
    c, t = se.remove_clips("^src1/", v.v_clips(spark, sf), v.v_transcript(spark, sf))
    return c.select(F.lit("clips").alias("what"), "clip_id").unionByName(t.select(F.lit("transcript").alias("what"), "clip_id"))


@query("lib09_library_status", "v_clips v_transcript", "SELECT 'library' AS what, 'clips' AS name, count(*) AS n FROM v_clips UNION ALL SELECT 'library', 'size', sum(size)::BIGINT FROM v_clips UNION ALL SELECT 'segments', source, count(*) FROM v_transcript GROUP BY 2 UNION ALL SELECT 'vectors', 'm' || (label % 2), count(*) FROM embeddings GROUP BY 2")
def lib09(spark: SparkSession, sf: str) -> DataFrame:
    e = v.table(spark, sf, "embeddings").select(F.concat(F.lit("m"), F.col("label") % 2).alias("model"))
    return se.library_status(v.v_clips(spark, sf), v.v_transcript(spark, sf), e)


@query("lib10_pipeline_snapshot", "v_clips v_transcript v_beats", "SELECT clip_id, (SELECT count(*) FROM v_transcript t WHERE t.clip_id = c.clip_id) AS segments, (SELECT count(*) FROM v_beats b WHERE b.clip_id = c.clip_id) AS beats FROM v_clips c")
def lib10(spark: SparkSession, sf: str) -> DataFrame:
    return se.pipeline_snapshot(v.v_clips(spark, sf), segments=v.v_transcript(spark, sf), beats=v.v_beats(spark, sf))


@query("lib10_latest_jobs", "", "SELECT o_orderkey AS job_id, o_orderdate AS at_ FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 25")
def lib10b(spark: SparkSession, sf: str) -> DataFrame:
    return se.latest_jobs(v.table(spark, sf, "orders").select(F.col("o_orderkey").alias("job_id"), F.col("o_orderdate").alias("at"))).withColumnRenamed("at", "at_")


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    return v.v_clips(spark, sf).select("clip_id", "path", "size", (F.col("clip_id") * 1.5).alias("mtime"), "text", "lang")


@query("src01_media_inventory", "", "SELECT source AS dir, sum(strlen(text) + 1)::BIGINT AS size FROM documents WHERE text IS NOT NULL GROUP BY 1")
def src01(spark: SparkSession, sf: str) -> DataFrame:
    """Texts written as files under a folder for each source, and found again; Spark's own markers are hidden files."""
    path = files.scratch(spark, "inventory")
    v.table(spark, sf, "documents").filter("text is not null").select("text", F.col("source").alias("dir")).write.partitionBy("dir").text(path)
    found = ct.scan_inventory(spark, path, ["txt"])
    return found.groupBy(F.regexp_extract("path", "/dir=([^/]+)/", 1).alias("dir")).agg(F.sum("size").alias("size"))


@query("src18_artifacts", "v_cand v_samples v_cards", """, d AS (SELECT 'candidates' AS kind, job_id AS id, count(*) AS items, round(sum(start), 3) AS total FROM v_cand GROUP BY 2
 UNION ALL SELECT 'signals', clip_id, count(*), round(sum(t), 3) FROM v_samples GROUP BY 2
 UNION ALL SELECT 'evidence', job_id, count(*), round(sum(anchor), 3) FROM (SELECT job_id, event, min(anchor) AS anchor FROM v_cand GROUP BY 1, 2) GROUP BY 2
 UNION ALL SELECT 'provenance', reel, count(*), round(sum(idx), 3) FROM v_cards WHERE reel % 10 = 0 GROUP BY 2)
SELECT kind, id::VARCHAR AS id, 'ok' AS state, items, total FROM d""")
def src18(spark: SparkSession, sf: str) -> DataFrame:
    """Four kinds of documents through the sink and back, each verified against its manifest."""
    c, s = v.v_cand(spark, sf), v.v_samples(spark, sf)
    scored = c.select("job_id", "event", "candidate_id", F.lit("B").alias("angle"), F.lit("SWITCH").alias("action"), "start", "end", "timeline_start", (F.col("timeline_start") + F.col("duration_s")).alias("timeline_end"), F.struct(*(F.round("score", 3).alias(n) for n in artifacts.NAMES)).alias("scores"))
    seen = s.select("clip_id", "t", F.col("sig").alias("motion"), F.col("k").alias("brightness"), F.col("sig").alias("sharpness"), (F.col("k") / 100.0).alias("obstruction"), (F.col("k") % 7 == 0).alias("frozen"))
    events = c.groupBy("job_id", "event").agg(F.min("anchor").alias("anchor"))
    cards = v.v_cards(spark, sf).filter("reel % 10 = 0").select(F.col("reel").alias("job_id"), F.col("idx").alias("pos"), F.lit("card").alias("role"), F.concat(F.col("idx").cast("string"), F.lit("/"), "name").alias("path"), F.sha2("name", 256).alias("sha256"))
    made = {
        "candidates": (artifacts.candidate_documents(scored, {"minimum_b_shot": 4.0, "minimum_a_recovery": 8.0}), "struct<events:array<struct<event_id:string,candidates:array<struct<id:string,start:double>>>>>", "flatten(transform(doc.events, e -> e.candidates))", "x.start"),
        "signals": (artifacts.signal_documents(seen, 1.0), "struct<samples:array<struct<t:double>>>", "doc.samples", "x.t"),
        "evidence": (artifacts.evidence_documents(events, scored, ["total"]), "struct<events:array<struct<event_id:string,anchor:double>>>", "doc.events", "x.anchor"),
        "provenance": (artifacts.provenance_documents(cards), "struct<inputs:array<struct<path:string>>>", "doc.inputs", "cast(split(x.path, '/')[0] as double)"),
    }
    out = None
    for kind, (docs_, schema, items, value) in made.items():
        path = files.scratch(spark, kind)
        artifacts.write_documents(docs_, path, slots=8)
        told = artifacts.read_documents(spark, path, schema).select(F.lit(kind).alias("kind"), "id", "state", F.expr(f"cast(size({items}) as bigint)").alias("items"), F.expr(f"round(aggregate({items}, 0D, (a, x) -> a + {value}), 3)").alias("total"))
        out = told if out is None else out.unionAll(told)
    return out


@query("src02_changed_files", "v_clips", "SELECT path FROM v_clips c WHERE NOT (clip_id % 2 = 0 AND clip_id % 10 <> 4 AND clip_id % 6 <> 2)")
def src02(spark: SparkSession, sf: str) -> DataFrame:
    i = inventory(spark, sf)
    c = i.filter("clip_id % 2 = 0").withColumns({"status": F.when(F.col("clip_id") % 10 == 4, "failed").otherwise("indexed"), "mtime": F.col("mtime") + F.when(F.col("clip_id") % 6 == 2, 1.0).otherwise(0.5)})
    return ct.changed_files(i, c).select("path")


@query("src03_hash_gate", "v_clips", """, h AS (SELECT path, sha256(text) AS sha, clip_id, min(path) OVER (PARTITION BY sha256(text)) AS f FROM v_clips), c AS (SELECT sha, min(clip_id) AS id FROM h GROUP BY 1), k AS (SELECT sha, CASE WHEN id % 7 = 0 THEN 'indexed' WHEN id % 7 = 1 THEN 'quarantined' ELSE 'failed' END AS status, id % 5 AS retries FROM c WHERE id % 3 <> 0)
SELECT path, h.sha, CASE WHEN path <> f THEN 'duplicate' WHEN status = 'indexed' THEN 'known' WHEN status = 'quarantined' OR retries >= 3 THEN 'quarantined' WHEN status IS NOT NULL THEN 'retry' ELSE 'new' END AS gate FROM h LEFT JOIN k USING (sha)""")
def src03(spark: SparkSession, sf: str) -> DataFrame:
    i = inventory(spark, sf)
    ids = i.groupBy(F.sha2("text", 256).alias("sha")).agg(F.min("clip_id").alias("id")).filter("id % 3 <> 0")
    cat = ids.select("sha", F.when(F.col("id") % 7 == 0, "indexed").when(F.col("id") % 7 == 1, "quarantined").otherwise("failed").alias("status"), (F.col("id") % 5).alias("retries"))
    return ct.hash_gate(i.select("path", F.col("text").alias("content")), cat)


@query("src04_upsert_catalog", "v_clips", """, o AS (SELECT path, size, 'old' AS lang, 't' || clip_id AS tags FROM v_clips WHERE clip_id % 3 <> 0), n AS (SELECT path, size + 1 AS size, lang FROM v_clips WHERE clip_id % 4 <> 0)
SELECT path, coalesce(n.size, o.size) AS size, coalesce(n.lang, o.lang) AS lang, o.tags FROM o FULL JOIN n USING (path)""")
def src04(spark: SparkSession, sf: str) -> DataFrame:
    i = inventory(spark, sf)
    old = i.filter("clip_id % 3 <> 0").select("path", "size", F.lit("old").alias("lang"), F.concat(F.lit("t"), "clip_id").alias("tags"))
    return ct.upsert_catalog(old, i.filter("clip_id % 4 <> 0").select("path", (F.col("size") + 1).alias("size"), "lang"))


@query("src05_prune", "v_clips v_transcript", "SELECT 'catalog' AS what, clip_id FROM v_clips WHERE clip_id % 4 <> 1 UNION ALL SELECT 'segments', clip_id FROM v_transcript WHERE clip_id NOT IN (SELECT clip_id FROM v_clips WHERE clip_id % 4 = 1) UNION ALL SELECT 'gone', clip_id FROM v_clips WHERE clip_id % 4 = 1")
def src05(spark: SparkSession, sf: str) -> DataFrame:
    i = inventory(spark, sf)
    (cat, seg), gone = ct.prune(i, i.filter("clip_id % 4 <> 1"), v.v_transcript(spark, sf))
    pick = lambda d, n: d.select(F.lit(n).alias("what"), "clip_id")
    return pick(cat, "catalog").unionByName(pick(seg, "segments")).unionByName(pick(gone, "gone"))


@query("src06_read_scenes", "v_cuts", "SELECT job_id, pos::INTEGER + 1 AS scene, round(source_in, 3) AS start_s, round(source_out, 3) AS end_s FROM v_cuts WHERE NOT (pos % 9 = 4)")
def src06(spark: SparkSession, sf: str) -> DataFrame:
    c = v.v_cuts(spark, sf)
    bad = F.col("pos") % 9 == 4
    a, b = F.format_string("%.3f", F.round("source_in", 3)), F.when(bad, F.lit("-1")).otherwise(F.format_string("%.3f", F.round("source_out", 3)))
    line = F.concat_ws(",", F.col("pos") + 1, a, b)
    text = c.groupBy("job_id").agg(F.concat(F.lit("# list\n\nScene Number, Start Time (seconds), End Time (seconds)\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", line.alias("x")))), lambda s: s["x"]), "\n"), F.lit("\n\n")).alias("text"))
    return ct.read_scenes(text.withColumnRenamed("job_id", "file")).withColumnRenamed("file", "job_id")


@query("src07_read_sidecars", "v_samples", """SELECT clip_id, event_id, k::DOUBLE AS start_s, CASE kind WHEN 'click' THEN CASE k % 3 WHEN 0 THEN k + 5e0 WHEN 1 THEN k + 2e0 ELSE NULL END WHEN 'view' THEN k + 2e0 END AS end_s,
CASE kind WHEN 'purchase' THEN 0.5e0 WHEN 'view' THEN CASE WHEN k % 2 = 0 THEN 0.25e0 END END AS score FROM v_samples WHERE kind IN ('click', 'view', 'purchase')""")
def src07(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf)
    k, n = F.col("k"), F.col("k").cast("string")
    j = lambda *x: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in x))
    end = F.when(k % 3 == 0, j('"end": ', (k + 5).cast("string"), ', "dur": 1')).when(k % 3 == 1, j('"end": "x", "out": ', (k + 2).cast("string"))).otherwise('"stop": 7')
    click = j('{"scenes": [], "segments": [{"begin": 1}, 4, {"start_s": "', n, '", ', end, "}]}")
    view = j('{"zz": [1], "other": [{"t": ', n, ', "start": true, "dur": 2, "score": ', F.when(k % 2 == 0, "true").otherwise('"1"'), F.when(k % 2 == 0, ', "prob": 0.25').otherwise(""), "}]}")
    purchase = j('[3, {"beat_time": ', n, ', "confidence": 0.5, "weight": 9}]')
    kind = F.col("kind")
    json = F.when(kind == "click", click).when(kind == "view", view).when(kind == "purchase", purchase).when(kind == "error", F.lit('{"beats": [{"x": 1}]}')).otherwise(F.lit("[broken"))
    rows = ct.read_sidecars(s.select(F.struct("clip_id", "event_id").alias("file"), json.alias("json")))
    return rows.select("file.clip_id", "file.event_id", "start_s", "end_s", "score")


@query("src08_words_to_notes", "v_transcript", "SELECT clip_id, substr(string_agg(text, ' ' ORDER BY seq, text), 1, 4000) AS notes FROM v_transcript WHERE source <> 'system' GROUP BY 1")
def src08(spark: SparkSession, sf: str) -> DataFrame:
    w = v.v_transcript(spark, sf).select("clip_id", "seq", F.when(F.col("source") == "system", "spacing").when(F.col("source") == "user", "word").alias("kind"), F.col("text").alias("word"))
    return ct.words_to_notes(w)


@query("src09_load_beats", "v_samples", "SELECT DISTINCT clip_id, k::DOUBLE AS t FROM v_samples WHERE kind IN ('click', 'view', 'purchase')")
def src09(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k").cast("string")
    json = F.when(F.col("kind") == "click", F.concat(F.lit('{"beats": ['), k, F.lit("]}"))).when(F.col("kind") == "view", F.concat(F.lit('[{"time": '), k, F.lit("}]"))).when(F.col("kind") == "purchase", F.concat(F.lit('{"beats": [{"t": '), k, F.lit('}, "x"]}'))).otherwise(F.lit('{"beats": ["none"]}'))
    return ct.load_beats(v.v_samples(spark, sf).select("clip_id", json.alias("json")))


@query("src10_camera_source", "v_clips", "SELECT clip_id, CASE clip_id % 5 WHEN 0 THEN 'dji' WHEN 1 THEN 'gopro' END AS camera FROM v_clips")
def src10(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("clip_id") % 5
    name = F.concat(F.when(k == 0, "card/DJI_").when(k == 1, "GP").when(k == 2, "GX01").when(k == 3, "GP/a").otherwise("dji_"), F.col("clip_id").cast("string"))
    return ct.camera_source(v.v_clips(spark, sf).select("clip_id", name.alias("filename"))).select("clip_id", "camera")


@query("src11_backfill_plan", "v_clips v_transcript v_beats", "SELECT clip_id, 'transcript' AS stage FROM v_clips WHERE clip_id NOT IN (SELECT clip_id FROM v_transcript WHERE length(text) >= 60) UNION ALL SELECT clip_id, 'beats' FROM v_clips WHERE clip_id NOT IN (SELECT clip_id FROM v_beats WHERE t > 0)")
def src11(spark: SparkSession, sf: str) -> DataFrame:
    t = v.v_transcript(spark, sf).select("clip_id", (F.length("text") < 60).alias("degraded"))
    b = v.v_beats(spark, sf).select("clip_id", (F.col("t") == 0).alias("degraded"))
    return ct.backfill_plan(v.v_clips(spark, sf), transcript=t, beats=b)


@query("src13_concat_cards", "v_samples v_cards", f", {REEL}, s AS (SELECT clip_id AS reel, event_id % 3 AS idx, t, CASE WHEN clip_id % 4 = 0 THEN kind ELSE 'b' END AS kind, event_id FROM v_samples), ok AS (SELECT reel FROM s GROUP BY 1 HAVING count(DISTINCT kind) = 1) SELECT s.reel, s.idx, round(s.t + v0, 6) AS t, s.kind, s.event_id FROM s JOIN ok USING (reel) JOIN reels x ON x.reel = s.reel AND x.idx = s.idx")
def src13(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).select(F.col("clip_id").alias("reel"), (F.col("event_id") % 3).alias("idx"), "t", F.when(F.col("clip_id") % 4 == 0, F.col("kind")).otherwise("b").alias("kind"), "event_id")
    return r(ct.concat_cards(s, tl.virtual_reel(v.v_cards(spark, sf))), "t")


@query("src14_resume_union", "v_samples", "SELECT clip_id, event_id, CASE WHEN event_id % 3 <> 0 THEN sig + 1 ELSE sig END AS sig FROM v_samples WHERE event_id % 3 <> 0 OR event_id % 2 = 0")
def src14(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).select("clip_id", "event_id", "sig")
    return ct.resume_union(s.filter("event_id % 2 = 0"), s.filter("event_id % 3 <> 0").withColumn("sig", F.col("sig") + 1), ["clip_id", "event_id"])


@query("src15_package_index", "v_clips", "SELECT path, strlen(text) AS bytes, sha256(text) AS sha256, CASE WHEN regexp_matches(path, '/en-') THEN 'evidence' WHEN regexp_matches(path, '^src1') THEN 'media' ELSE 'other' END AS purpose FROM v_clips WHERE NOT (clip_id % 10 = 0)")
def src15(spark: SparkSession, sf: str) -> DataFrame:
    f = v.v_clips(spark, sf).select(F.when(F.col("clip_id") % 10 == 0, F.concat("path", F.lit("/index.json"))).otherwise(F.col("path")).alias("path"), F.col("text").alias("content"))
    return ct.package_index(f, {"evidence": "/en-", "media": "^src1"})


@query("src16_verify_hashes", "v_clips", "SELECT path, CASE WHEN clip_id % 5 = 0 THEN 'unrecorded' WHEN clip_id % 7 = 0 THEN 'missing' WHEN clip_id % 11 = 0 THEN 'changed' ELSE 'ok' END AS state FROM v_clips WHERE NOT (clip_id % 5 = 0 AND clip_id % 7 = 0)")
def src16(spark: SparkSession, sf: str) -> DataFrame:
    c = v.v_clips(spark, sf).select("clip_id", "path", F.sha2("text", 256).alias("sha"))
    return ct.verify_hashes(c.filter("clip_id % 5 <> 0"), c.filter("clip_id % 7 <> 0").withColumn("sha", F.when(F.col("clip_id") % 11 == 0, F.lit("x")).otherwise(F.col("sha"))))


@query("src17_fingerprint", "v_clips", "SELECT clip_id, sha256('lang=' || lang || '|path=' || path || '|size=' || size) AS fingerprint FROM v_clips")
def src17(spark: SparkSession, sf: str) -> DataFrame:
    return ct.fingerprint(v.v_clips(spark, sf), ["path", "size", "lang"]).select("clip_id", "fingerprint")


