"""Domain views over the driver's tables: each as a DataFrame, and as SQL text for the twins.

The given tables hold no video; events stand for samples, beats and cuts, embeddings for frames, lineitem for cards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def v_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clip_id, t (hours since the clip's first event, read as seconds), sig, kind, event_id, k (a number of the properties)."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("clip_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), F.col("value").alias("sig"), F.col("event_type").alias("kind"), "event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    first = F.min("us").over(Window.partitionBy("clip_id"))
    return e.select("clip_id", ((F.col("us") - first) / 1e6 / 3600).alias("t"), "sig", "kind", "event_id", "k")


def v_beats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = v_samples(spark, sf_dir).filter(F.col("kind").isin("click", "view"))
    return s.select("clip_id", (F.row_number().over(Window.partitionBy("clip_id").orderBy("t")) - 1).alias("i"), "t")


def v_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """job_id, pos from 0, cut_id, angle, source_in, source_out, confidence."""
    w = Window.partitionBy("clip_id").orderBy("t")
    s = v_samples(spark, sf_dir).select(F.col("clip_id").alias("job_id"), (F.row_number().over(w) - 1).alias("pos"), F.when(F.col("kind").isin("view", "click", "signup"), "A").otherwise("B").alias("angle"), F.col("t").alias("source_in"), F.lead("t").over(w).alias("source_out"), F.when(F.col("sig") < 10, "low").otherwise("high").alias("confidence"))
    return s.filter("source_out is not null").withColumn("cut_id", F.format_string("cut_%03d", "pos"))


def v_cand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """job_id, event (number), candidate_id, anchor, start, end, timeline_start, duration_s, score."""
    s = v_samples(spark, sf_dir).filter("kind = 'purchase'")
    length = 4 + F.col("sig") % 10
    return s.select(F.col("clip_id").alias("job_id"), F.floor(F.col("k") / 10).cast("int").alias("event"), F.format_string("c%06d", "event_id").alias("candidate_id"), F.col("t").alias("anchor"), F.col("t").alias("start"), (F.col("t") + length).alias("end"), (F.col("t") + F.col("k") / 100.0).alias("timeline_start"), length.alias("duration_s"), (F.col("sig") / 500.0).alias("score"))


def cand_number() -> Column:
    """The number in a candidate's id: six digits or more."""
    return F.substr("candidate_id", F.lit(2)).cast("bigint")


def v_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """reel, idx from 0, name, duration_s: the files of a virtual reel in order."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("reel"), (F.row_number().over(w) - 1).alias("idx"), F.format_string("p%d", "l_partkey").alias("name"), F.col("l_quantity").alias("duration_s"))


def v_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clip_id, frame_no, px: 8 x 8 grey pixels."""
    e = table(spark, sf_dir, "embeddings")
    px = F.transform("embedding", lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(128 + 256 * x.cast("double")).cast("int"))))
    return e.select(F.col("label").cast("bigint").alias("clip_id"), F.col("vec_id").alias("frame_no"), px.alias("px"))


def v_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clip_id, frame_no, y, x, v."""
    return v_frames(spark, sf_dir).select("clip_id", "frame_no", F.posexplode("px").alias("p", "v")).select("clip_id", "frame_no", F.floor(F.col("p") / 8).cast("int").alias("y"), (F.col("p") % 8).alias("x"), "v")


def v_rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clip_id, frame_no, p, r, g, b: 21 pixels."""
    at = lambda c: F.element_at("px", F.col("p") * 3 + c + 1)
    return v_frames(spark, sf_dir).withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(20)))).select("clip_id", "frame_no", "p", at(0).alias("r"), at(1).alias("g"), at(2).alias("b"))


def v_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("clip_id"), F.concat(F.col("source"), F.lit("/"), F.col("lang"), F.lit("-"), F.col("doc_id").cast("string"), F.lit(".mov")).alias("path"), F.col("source").alias("dir"), "lang", F.col("n_chars").alias("size"), "text")


def v_transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("clip_id"), F.col("turn").alias("seq"), F.col("role").alias("source"), "text")


#: The same views as SQL; a view may use those above it.
SQL = {
    "v_samples": "SELECT user_id AS clip_id, (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id)) / 1e6 / 3600 AS t, value AS sig, event_type AS kind, event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events",
    "v_beats": "SELECT clip_id, row_number() OVER (PARTITION BY clip_id ORDER BY t) - 1 AS i, t FROM v_samples WHERE kind IN ('click','view')",
    "v_cuts": "SELECT * FROM (SELECT clip_id AS job_id, row_number() OVER w - 1 AS pos, CASE WHEN kind IN ('view','click','signup') THEN 'A' ELSE 'B' END AS angle, t AS source_in, lead(t) OVER w AS source_out, CASE WHEN sig < 10 THEN 'low' ELSE 'high' END AS confidence, printf('cut_%03d', row_number() OVER w - 1) AS cut_id FROM v_samples WINDOW w AS (PARTITION BY clip_id ORDER BY t)) WHERE source_out IS NOT NULL",
    "v_cand": "SELECT clip_id AS job_id, CAST(k // 10 AS INTEGER) AS event, printf('c%06d', event_id) AS candidate_id, t AS anchor, t AS start, t + (4 + sig % 10) AS \"end\", t + k / 100e0 AS timeline_start, 4 + sig % 10 AS duration_s, sig / 500e0 AS score FROM v_samples WHERE kind = 'purchase'",
    "v_cards": "SELECT l_orderkey AS reel, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS idx, 'p' || l_partkey AS name, l_quantity AS duration_s FROM lineitem",
    "v_frames": "SELECT CAST(label AS BIGINT) AS clip_id, vec_id AS frame_no, list_transform(embedding, lambda x: greatest(0, least(255, CAST(floor(128 + 256 * CAST(x AS DOUBLE)) AS INTEGER)))) AS px FROM embeddings",
    "v_pixels": "SELECT clip_id, frame_no, CAST((p - 1) // 8 AS INTEGER) AS y, CAST((p - 1) % 8 AS INTEGER) AS x, px[p] AS v FROM v_frames, (SELECT unnest(range(1, 65)) AS p)",
    "v_rgb": "SELECT clip_id, frame_no, CAST(p AS INTEGER) AS p, px[p*3+1] AS r, px[p*3+2] AS g, px[p*3+3] AS b FROM v_frames, (SELECT unnest(range(0, 21)) AS p)",
    "v_clips": "SELECT doc_id AS clip_id, source || '/' || lang || '-' || doc_id || '.mov' AS path, source AS dir, lang, n_chars AS size, text FROM documents",
    "v_transcript": "SELECT conv_id AS clip_id, turn AS seq, role AS source, text FROM conversations",
}


def cte(views: str) -> str:
    """WITH ... for the named views and those they use, ready for more common tables or a SELECT."""
    wanted = set(views.split())
    for name in reversed(SQL):
        if name in wanted:
            wanted |= {v for v in SQL if v in SQL[name]}
    parts = [f"{name} AS ({SQL[name]})" for name in SQL if name in wanted]
    return f"WITH RECURSIVE {', '.join(parts)} " if parts else ""
