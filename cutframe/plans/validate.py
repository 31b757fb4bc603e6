"""VAL rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import timeline as tl
from ..operators import validate as va
from ..sources import views as v
from . import query
from .timeline import REEL


@query("val02_registry", "", """WITH m AS (SELECT o_orderkey AS job_id, 'grade' AS category, 'Brand#' || (o_orderkey % 40) AS name FROM orders), g AS (SELECT DISTINCT 'grade' AS category, p_brand AS name FROM part)
SELECT m.job_id, m.category, m.name, coalesce((SELECT string_agg(name, ',' ORDER BY name) FROM g WHERE g.category = m.category), '') AS known FROM m WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.category = m.category AND g.name = m.name)""")
def val02(spark: SparkSession, sf: str) -> DataFrame:
    m = v.table(spark, sf, "orders").select(F.col("o_orderkey").alias("job_id"), F.lit("grade").alias("category"), F.concat(F.lit("Brand#"), F.col("o_orderkey") % 40).alias("name"))
    return va.validate_registry(m, v.table(spark, sf, "part").select(F.lit("grade").alias("category"), F.col("p_brand").alias("name")).distinct())


def odd_cuts(spark: SparkSession, sf: str) -> DataFrame:
    """Cuts with planted faults: repeated ids, empty and out-of-order ranges."""
    c = v.v_cuts(spark, sf)
    return c.withColumns({"cut_id": F.when(F.col("pos") % 13 == 5, F.format_string("cut_%03d", F.col("pos") - 1)).otherwise(F.col("cut_id")), "source_out": F.when(F.col("pos") % 17 == 3, F.col("source_in")).otherwise(F.col("source_out")), "source_in": F.when(F.col("pos") % 19 == 7, F.col("source_in") - 100).otherwise(F.col("source_in"))})


ODD = "oc AS (SELECT job_id, pos, angle, CASE WHEN pos % 19 = 7 THEN source_in - 100 ELSE source_in END AS source_in, CASE WHEN pos % 17 = 3 THEN source_in ELSE source_out END AS source_out, CASE WHEN pos % 13 = 5 THEN printf('cut_%03d', pos - 1) ELSE cut_id END AS cut_id FROM v_cuts)"
TIMELINE = ODD + """, ow AS (SELECT *, min(pos) OVER (PARTITION BY job_id, cut_id) AS f, lag(source_in) OVER a AS pi, lag(source_out) OVER a AS po FROM oc WINDOW a AS (PARTITION BY job_id, angle ORDER BY pos)),
vt AS (SELECT * FROM (SELECT job_id, pos, unnest([CASE WHEN pos > f THEN 'duplicate_id' END, CASE WHEN source_out <= source_in THEN 'empty' END, CASE WHEN source_in < pi THEN 'out_of_order' WHEN source_in < po - 1e-6 THEN 'overlap' END, CASE WHEN angle = 'B' AND job_id % 4 = 0 THEN 'no_b_reel' END]) AS rule FROM ow) WHERE rule IS NOT NULL)"""


def _timeline(spark: SparkSession, sf: str) -> DataFrame:
    cuts = odd_cuts(spark, sf)
    return va.validate_timeline(cuts, cuts.filter("job_id % 4 <> 0"))


@query("val03_timeline", "v_cuts", f", {TIMELINE} SELECT * FROM vt")
def val03(spark: SparkSession, sf: str) -> DataFrame:
    return _timeline(spark, sf)


MEDIA = REEL + """, ln AS (SELECT DISTINCT job_id, 300e0 + job_id % 7 * 50 AS a_len, (SELECT max(v1) FROM reels WHERE reel = job_id) AS b_len FROM v_cuts WHERE job_id % 9 <> 0),
vm AS (SELECT * FROM (SELECT c.job_id, pos, CASE WHEN CASE WHEN angle = 'A' THEN a_len ELSE b_len END IS NULL THEN 'missing_source' WHEN source_out > CASE WHEN angle = 'A' THEN a_len ELSE b_len END + 1e-6 THEN lower(angle) || '_past_end' END AS rule, NULL::DOUBLE AS at_s FROM v_cuts c LEFT JOIN ln USING (job_id)
 UNION ALL SELECT c.job_id, pos, 'crosses_file', min(v0) FROM v_cuts c JOIN reels r ON r.reel = c.job_id AND v0 > 0 AND v0 > source_in AND v0 < source_out WHERE angle = 'B' GROUP BY 1, 2) WHERE rule IS NOT NULL)"""


def _media(spark: SparkSession, sf: str) -> DataFrame:
    cuts = v.v_cuts(spark, sf)
    reel = tl.virtual_reel(v.v_cards(spark, sf)).withColumnRenamed("reel", "job_id")
    ends = reel.groupBy("job_id").agg(F.max("end").alias("b_len"))
    sources = cuts.select("job_id").distinct().filter("job_id % 9 <> 0").withColumn("a_len", 300.0 + F.col("job_id") % 7 * 50).join(ends, "job_id", "left")
    return va.validate_media(cuts, sources, reel)


@query("val04_media", "v_cuts v_cards", f", {MEDIA} SELECT * FROM vm")
def val04(spark: SparkSession, sf: str) -> DataFrame:
    return _media(spark, sf).withColumnRenamed("at", "at_s")


@query("val05_pregrades", "v_samples", """, p AS (SELECT clip_id AS job_id, kind AS source, row_number() OVER (PARTITION BY clip_id, kind ORDER BY t) AS i, CASE WHEN k % 10 = 0 THEN 'x' || k ELSE round(t, 3)::VARCHAR END AS tt, CASE WHEN k % 25 = 3 THEN 'n/a' ELSE sig::VARCHAR END AS gt FROM v_samples),
q AS (SELECT *, try_cast(tt AS DOUBLE) AS t, try_cast(gt AS DOUBLE) AS g FROM (SELECT job_id, source, i, CASE WHEN i % 7 = 0 THEN '1.5' ELSE tt END AS tt, gt FROM p)), w AS (SELECT *, lag(t) OVER (PARTITION BY job_id, source ORDER BY i) AS pt FROM q)
SELECT * FROM (SELECT job_id, source, i, unnest([CASE WHEN source = 'error' THEN 'undeclared_source' END, CASE WHEN t IS NULL THEN 'bad_time' END, CASE WHEN g IS NULL THEN 'bad_gain' END, CASE WHEN t <= pt THEN 'not_rising' END]) AS rule FROM w) WHERE rule IS NOT NULL""")
def val05(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).withColumn("i", F.row_number().over(Window.partitionBy("clip_id", "kind").orderBy("t")))
    t_text = F.when(F.col("i") % 7 == 0, "1.5").when(F.col("k") % 10 == 0, F.concat(F.lit("x"), "k")).otherwise(F.round("t", 3).cast("string"))
    points = s.select(F.col("clip_id").alias("job_id"), F.col("kind").alias("source"), F.col("i").cast("bigint").alias("i"), t_text.alias("t_text"), F.when(F.col("k") % 25 == 3, "n/a").otherwise(F.col("sig").cast("string")).alias("gain_text"))
    return va.validate_pregrades(points, points.filter("source <> 'error'"))


@query("val06_spans", "v_cuts v_cards", f""", {REEL}, ln AS (SELECT reel AS job_id, max(v1) AS length FROM reels GROUP BY 1), s AS (SELECT job_id, pos, CASE WHEN pos % 23 = 1 THEN -source_in - 1 ELSE source_in END AS start, CASE WHEN pos % 29 = 2 THEN 0 ELSE source_out - source_in END AS dur FROM v_cuts)
SELECT * FROM (SELECT s.job_id, pos, CASE WHEN start < 0 THEN 'negative_start' WHEN dur <= 0 THEN 'no_duration' WHEN length IS NULL THEN 'missing_source' WHEN start + dur > length + 0.05 THEN 'past_end' END AS rule FROM s LEFT JOIN ln USING (job_id)) WHERE rule IS NOT NULL""")
def val06(spark: SparkSession, sf: str) -> DataFrame:
    c = v.v_cuts(spark, sf)
    spans = c.select("job_id", "pos", F.when(F.col("pos") % 23 == 1, -F.col("source_in") - 1).otherwise(F.col("source_in")).alias("start"), F.when(F.col("pos") % 29 == 2, 0.0).otherwise(F.col("source_out") - F.col("source_in")).alias("dur"))
    length = tl.virtual_reel(v.v_cards(spark, sf)).groupBy(F.col("reel").alias("job_id")).agg(F.max("end").alias("length"))
    return va.validate_spans(spans, length)


@query("val07_manifest_verdict", "v_cuts v_cards", f""", {TIMELINE}, {MEDIA}, al AS (SELECT job_id, rule FROM vt UNION ALL SELECT job_id, rule FROM vm), g AS (SELECT job_id, rule, count(*) AS n FROM al GROUP BY 1, 2),
b AS (SELECT job_id, string_agg(CASE WHEN rule <> 'crosses_file' THEN rule || '=' || n END, ',' ORDER BY rule || '=' || n) AS e, string_agg(CASE WHEN rule = 'crosses_file' THEN rule || '=' || n END, ',') AS o FROM g GROUP BY 1)
SELECT j.job_id, coalesce(e, '') = '' AS valid, coalesce(e, '') AS errors, coalesce(o, '') AS notes FROM (SELECT DISTINCT job_id FROM v_cuts) j LEFT JOIN b USING (job_id)""")
def val07(spark: SparkSession, sf: str) -> DataFrame:
    every = _timeline(spark, sf).select("job_id", "rule").unionByName(_media(spark, sf).select("job_id", "rule"))
    return va.manifest_verdict(v.v_cuts(spark, sf), every)


@query("val08_sequence_check", "v_cuts", """, f AS (SELECT job_id, CASE WHEN pos % 31 = 4 THEN 'seg' || pos || '.mov' WHEN pos % 37 = 6 THEN printf('seg_%04d.mov', pos - 1) WHEN pos % 41 = 8 THEN printf('seg_%04d.mov', pos + 5000) ELSE printf('seg_%04d.mov', pos) END AS name FROM v_cuts),
p AS (SELECT job_id, CASE WHEN regexp_full_match(name, 'seg_(\\d{4})\\.mov') THEN regexp_extract(name, 'seg_(\\d{4})', 1)::BIGINT END AS idx FROM f), h AS (SELECT job_id, idx, count(*) AS k FROM p WHERE idx IS NOT NULL GROUP BY 1, 2),
w AS (SELECT job_id, unnest(range(0, n)) AS idx FROM (SELECT job_id, count(*) AS n FROM v_cuts GROUP BY 1))
SELECT job_id, idx, 'bad_name' AS problem FROM p WHERE idx IS NULL UNION ALL SELECT job_id, idx, 'duplicate' FROM h WHERE k > 1 UNION ALL SELECT job_id, idx, 'missing' FROM w WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.job_id = w.job_id AND h.idx = w.idx)
UNION ALL SELECT job_id, idx, 'out_of_range' FROM h WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.job_id = h.job_id AND w.idx = h.idx)""")
def val08(spark: SparkSession, sf: str) -> DataFrame:
    c = v.v_cuts(spark, sf)
    pos = F.col("pos")
    name = F.when(pos % 31 == 4, F.concat(F.lit("seg"), pos, F.lit(".mov"))).when(pos % 37 == 6, F.format_string("seg_%04d.mov", pos - 1)).when(pos % 41 == 8, F.format_string("seg_%04d.mov", pos + 5000)).otherwise(F.format_string("seg_%04d.mov", pos))
    want = c.groupBy("job_id").agg(F.count("*").alias("n")).withColumn("first", F.lit(0).cast("bigint"))
    return va.sequence_check(c.select("job_id", name.alias("name")), r"^seg_(\d{4})\.mov$", want)


CMD = """cm AS (SELECT event_id AS cmd_id, 'ffmpeg' || CASE WHEN k % 3 = 0 THEN ' -stream_loop -1' ELSE '' END || CASE WHEN k % 7 = 0 THEN ' -f concat' WHEN k % 7 = 1 THEN ' -f mp4' ELSE '' END || ' -i a.mov' || CASE WHEN k % 2 = 0 THEN ' -i b.wav' ELSE '' END
|| CASE k % 5 WHEN 0 THEN ' -c:v copy -pix_fmt yuv420p' WHEN 1 THEN ' -c copy -crf 20' WHEN 2 THEN ' -vn' ELSE ' -c:v h264_vaapi' END || CASE WHEN k % 11 = 0 THEN ' -vf format=nv12,hwupload,scale_vaapi=w=320' ELSE '' END || CASE k % 4 WHEN 1 THEN ' -c:a aac -b:a 192k' WHEN 2 THEN ' -c:a aac -b:a 320k' ELSE '' END
|| CASE k % 6 WHEN 1 THEN ' -filter_complex [1:a]alimiter=limit=0.95[o]' WHEN 2 THEN ' -filter_complex [2:s]alimiter=limit=0.97[o]' ELSE '' END || CASE WHEN k % 9 = 0 THEN ' -shortest' ELSE '' END AS cmd FROM v_samples),
wd AS (SELECT cmd_id, cmd, w, len(list_filter(range(1, len(w)), lambda i: w[i] = '-i')) AS n FROM (SELECT *, string_split_regex(trim(cmd), '\\s+') AS w FROM cm))"""


def commands(spark: SparkSession, sf: str) -> DataFrame:
    k, nil = F.col("k"), F.lit("")
    s = v.v_samples(spark, sf)
    on = lambda c, x: F.when(c, x).otherwise(nil)
    cmd = F.concat(
        F.lit("ffmpeg"), on(k % 3 == 0, " -stream_loop -1"), F.when(k % 7 == 0, " -f concat").when(k % 7 == 1, " -f mp4").otherwise(nil), F.lit(" -i a.mov"), on(k % 2 == 0, " -i b.wav"),
        F.when(k % 5 == 0, " -c:v copy -pix_fmt yuv420p").when(k % 5 == 1, " -c copy -crf 20").when(k % 5 == 2, " -vn").otherwise(" -c:v h264_vaapi"),
        on(k % 11 == 0, " -vf format=nv12,hwupload,scale_vaapi=w=320"), F.when(k % 4 == 1, " -c:a aac -b:a 192k").when(k % 4 == 2, " -c:a aac -b:a 320k").otherwise(nil),
        F.when(k % 6 == 1, " -filter_complex [1:a]alimiter=limit=0.95[o]").when(k % 6 == 2, " -filter_complex [2:s]alimiter=limit=0.97[o]").otherwise(nil), on(k % 9 == 0, " -shortest"),
    )
    return s.select(F.col("event_id").alias("cmd_id"), "clip_id", cmd.alias("cmd"))


@query("val09_lint_commands", "v_samples", f""", {CMD} SELECT * FROM (SELECT cmd_id, unnest([CASE WHEN list_contains(w, '-stream_loop') AND list_contains(w, '-shortest') THEN 'streamloop-shortest' END,
CASE WHEN (list_contains(w, 'h264_vaapi') OR list_contains(w, '-vaapi_device')) AND ((n > 0 AND w[list_position(w, '-f') + 1] = 'concat') OR len(list_filter(w, lambda x: starts_with(x, 'concat='))) > 0) AND n > 1 THEN 'vaapi-concat' END,
CASE WHEN n > 0 AND coalesce(list_max(list_transform(regexp_extract_all(cmd, '\\[(\\d+):[vas]\\]', 1), lambda x: x::INT)) >= n, false) THEN 'stream-label-mismatch' END,
CASE WHEN len(list_filter(range(1, len(w)), lambda i: regexp_full_match(w[i], '-c(:[va](:\\d+)?)?') AND w[i + 1] = 'copy')) > 0 AND len(list_filter(w, lambda x: x IN ('-pix_fmt', '-profile:v') OR starts_with(x, '-pix_fmt=') OR starts_with(x, '-profile:v='))) > 0 THEN 'copy-encoder-opts' END,
CASE WHEN contains(cmd, 'scale_vaapi') THEN 'scale-vaapi-unsupported' END, CASE WHEN contains(cmd, 'alimiter=limit=0.95') THEN 'limiter-095-locked-chain' END,
CASE WHEN len(list_filter(w, lambda x: starts_with(x, '-c:v') OR x = '-movflags')) > 0 AND len(list_filter(range(1, len(w) + 1), lambda i: w[i] = '-b:a=192k' OR (w[i] = '-b:a' AND w[i + 1] = '192k'))) > 0 THEN 'aac-192k-locked-chain' END]) AS rule FROM wd) WHERE rule IS NOT NULL""")
def val09(spark: SparkSession, sf: str) -> DataFrame:
    return va.lint_commands(commands(spark, sf))


@query("val09_mixed_concat_lists", "v_cards", "SELECT reel AS list_id, count(DISTINCT duration_s % 3) AS kinds FROM v_cards GROUP BY 1 HAVING count(DISTINCT duration_s % 3) > 1")
def val09b(spark: SparkSession, sf: str) -> DataFrame:
    return va.mixed_concat_lists(v.v_cards(spark, sf).select(F.col("reel").alias("list_id"), (F.col("duration_s") % 3).alias("signature")))


@query("val10_scan_logs", "", """WITH l AS (SELECT doc_id AS log_id, string_split(text, chr(10)) AS ls FROM documents), x AS (SELECT log_id, unnest(range(1, len(ls) + 1))::INTEGER AS line, unnest(ls) AS body FROM l)
SELECT * FROM (SELECT log_id, line, unnest([CASE WHEN regexp_matches(body, '(?i)token\\s*=') THEN 'secret' END, CASE WHEN regexp_matches(body, '[%&*#$]{3}') THEN 'noise' END]) AS pattern FROM x) WHERE pattern IS NOT NULL""")
def val10(spark: SparkSession, sf: str) -> DataFrame:
    return va.scan_logs(v.table(spark, sf, "documents").select(F.col("doc_id").alias("log_id"), "text"), {"secret": r"(?i)token\s*=", "noise": r"[%&*#$]{3}"})


@query("val01_structure", "", """WITH d AS (SELECT event_id AS doc_id, CASE event_type WHEN 'error' THEN '{"job_id": "x"' WHEN 'click' THEN '{"job_id": "job_' || user_id || '", "fps": ' || (event_id % 60) || '}' WHEN 'view' THEN '{"job_id": "JOB ' || user_id || '", "fps": 25, "extra": 1}' ELSE '{"fps": 30}' END AS json FROM events)
SELECT doc_id, '$' AS path, 'not_json' AS rule FROM d WHERE NOT json_valid(json)
UNION ALL SELECT doc_id, '$.job_id', CASE WHEN json->>'$.job_id' IS NULL THEN 'missing' ELSE 'pattern' END FROM (SELECT * FROM d WHERE json_valid(json)) WHERE json->>'$.job_id' IS NULL OR NOT regexp_full_match(json->>'$.job_id', 'job_[0-9]+')
UNION ALL SELECT doc_id, '$.fps', 'pattern' FROM (SELECT * FROM d WHERE json_valid(json)) WHERE NOT regexp_full_match(json->>'$.fps', '25|30|50')
UNION ALL SELECT doc_id, '$.extra', 'unknown' FROM (SELECT * FROM d WHERE json_valid(json)) WHERE json->>'$.extra' IS NOT NULL""")
def val01(spark: SparkSession, sf: str) -> DataFrame:
    e, user = v.table(spark, sf, "events"), F.col("user_id").cast("string")
    kind = F.col("event_type")
    json = F.when(kind == "error", '{"job_id": "x"').when(kind == "click", F.concat(F.lit('{"job_id": "job_'), user, F.lit('", "fps": '), (F.col("event_id") % 60).cast("string"), F.lit("}"))).when(kind == "view", F.concat(F.lit('{"job_id": "JOB '), user, F.lit('", "fps": 25, "extra": 1}'))).otherwise('{"fps": 30}')
    return va.structure_violations(e.select(F.col("event_id").alias("doc_id"), json.alias("json")), {"job_id": r"^job_[0-9]+$", "fps": r"^(25|30|50)$"}, ("job_id", "fps"))


@query("val01_manifest", "v_cuts", """, w AS (SELECT job_id, count(*) AS n FROM v_cuts GROUP BY 1)
SELECT job_id AS doc_id, CASE job_id % 6 WHEN 0 THEN '$.manifest_version' WHEN 1 THEN '$.profiles' WHEN 2 THEN '$.sources.b_reel[1]' ELSE '$' END AS path, CASE job_id % 6 WHEN 0 THEN 'among' WHEN 1 THEN 'unknown' WHEN 2 THEN 'length' ELSE 'missing' END AS rule, CASE job_id % 6 WHEN 1 THEN 'lut' WHEN 3 THEN 'template' END AS field FROM w WHERE job_id % 6 < 4
UNION ALL SELECT job_id, '$.timeline[' || pos || '].' || f.place, f.rule, NULL FROM (SELECT job_id, pos, unnest([CASE WHEN pos % 5 = 0 THEN {'place': 'angle', 'rule': 'among'} END, CASE WHEN pos > 999 THEN {'place': 'id', 'rule': 'pattern'} END, CASE WHEN pos % 7 = 3 THEN {'place': 'source_in', 'rule': 'range'} END]) AS f FROM v_cuts WHERE job_id % 6 <> 3) WHERE f IS NOT NULL""")
def val01b(spark: SparkSession, sf: str) -> DataFrame:
    """One manifest a job, faults by its number and its cuts' places."""
    angle = F.when(F.col("pos") % 5 == 0, "C").otherwise(F.col("angle"))
    begin = F.when(F.col("pos") % 7 == 3, -1.0).otherwise(F.col("source_in"))
    cut = F.struct(F.col("pos"), F.col("cut_id").alias("id"), angle.alias("angle"), begin.alias("source_in"), "source_out", "confidence")
    jobs = v.v_cuts(spark, sf).groupBy("job_id").agg(F.array_sort(F.collect_list(cut)).alias("cuts"))
    k = F.col("job_id") % 6
    timeline = F.transform("cuts", lambda c: c.dropFields("pos"))
    reels = F.struct(F.lit("a.mov").alias("a_reel"), F.array(F.lit("b.mov"), F.when(k == 2, "").otherwise("c.mov")).alias("b_reel"))
    profiles = F.struct(*(F.lit(f"{n}_v1").alias(n) for n in ("grade", "crop", "graphics", "audio")), F.when(k == 1, "x").alias("lut"))
    whole = F.struct(F.when(k == 0, 2).otherwise(1).alias("manifest_version"), F.concat(F.lit("job_"), F.col("job_id").cast("string")).alias("job_id"), F.when(k != 3, "t_v1").alias("template"), reels.alias("sources"), timeline.alias("timeline"), profiles.alias("profiles"))
    return va.manifest_violations(jobs.select(F.col("job_id").alias("doc_id"), F.to_json(whole).alias("json")))
