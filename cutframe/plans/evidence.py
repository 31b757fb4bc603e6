"""EVD rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import evidence as ev
from ..sources import views as v
from . import query
from .timeline import r


@query("evd01_event_anchor", "v_cand", """, c AS (SELECT job_id, event, anchor AS pos, CASE WHEN score > 0.1 THEN 'SWITCH' ELSE 'HOLD' END AS action, timeline_start AS ts FROM v_cand), x AS (SELECT job_id, event, min(anchor) AS m FROM v_cand GROUP BY 1, 2),
g AS (SELECT job_id, event, min(ts) FILTER (WHERE action = 'SWITCH') AS sw, min_by(ts, pos) AS fs FROM c GROUP BY 1, 2), k AS (SELECT g.*, CASE WHEN event % 4 = 0 THEN m END AS beat, CASE WHEN event % 3 = 0 THEN m + 1 END AS slot FROM g JOIN x USING (job_id, event))
SELECT job_id, event, coalesce(beat, sw, slot, fs) AS anchor, CASE WHEN beat IS NOT NULL THEN 'beat' WHEN sw IS NOT NULL THEN 'switch' WHEN slot IS NOT NULL THEN 'slot' ELSE 'first' END AS how FROM k""")
def evd01(spark: SparkSession, sf: str) -> DataFrame:
    c = v.v_cand(spark, sf)
    x = c.groupBy("job_id", "event").agg(F.min("anchor").alias("m")).select("job_id", "event", F.when(F.col("event") % 4 == 0, F.col("m")).alias("beat"), F.when(F.col("event") % 3 == 0, F.col("m") + 1).alias("slot"))
    return ev.event_anchor(c.select("job_id", "event", F.col("anchor").alias("pos"), F.when(F.col("score") > 0.1, "SWITCH").otherwise("HOLD").alias("action"), "timeline_start"), x)


EVENTS = "ea AS (SELECT job_id, event, min(anchor) AS anchor FROM v_cand GROUP BY 1, 2)"


def events(spark: SparkSession, sf: str) -> DataFrame:
    return v.v_cand(spark, sf).groupBy("job_id", "event").agg(F.min("anchor").alias("anchor"))


@query("evd02_select_span", "v_cand", f", {EVENTS}, n AS (SELECT job_id, count(*) FILTER (WHERE NOT anchor BETWEEN 100 - 1e-6 AND 500 + 1e-6) AS outside, greatest(count(*) FILTER (WHERE anchor BETWEEN 100 - 1e-6 AND 500 + 1e-6) - 4, 0) AS truncated FROM ea GROUP BY 1) SELECT job_id, event, anchor, outside, truncated FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY anchor, event) AS k FROM ea WHERE anchor BETWEEN 100 - 1e-6 AND 500 + 1e-6) JOIN n USING (job_id) WHERE k <= 4")
def evd02(spark: SparkSession, sf: str) -> DataFrame:
    return ev.select_span(events(spark, sf), 100.0, 500.0, 4)


@query("evd03_strip_aggregates", "v_samples", "SELECT event_id, CASE WHEN kind = 'click' THEN 'total' WHEN kind = 'view' THEN 'rank,total' ELSE '' END AS dropped, 1 AS kept FROM v_samples")
def evd03(spark: SparkSession, sf: str) -> DataFrame:
    pairs = F.when(F.col("kind") == "click", F.map_from_arrays(F.array(F.lit("k"), F.lit("total")), F.array("k", "k"))).when(F.col("kind") == "view", F.map_from_arrays(F.array(F.lit("total"), F.lit("k"), F.lit("rank")), F.array("k", "k", "k"))).otherwise(F.map_from_arrays(F.array(F.lit("k")), F.array("k")))
    out = ev.strip_aggregates(v.v_samples(spark, sf).select("event_id", pairs.alias("fields")), ["total", "rank", "average"])
    return out.select("event_id", F.array_join("dropped", ",").alias("dropped"), F.size("fields").alias("kept"))


@query("evd04_aggregate_hits", "v_samples", """SELECT event_id AS doc_id, unnest(CASE kind WHEN 'click' THEN ['$.a.total_s', '$.a.l[1].avg'] WHEN 'view' THEN ['$.rank', '$.b.c.d.e.f[0].mean_x'] WHEN 'purchase' THEN CASE WHEN k % 2 = 0 THEN ['$[0].total', '$[1][0].rank_' || k] ELSE ['$[0].total'] END ELSE [] END) AS path FROM v_samples""")
def evd04(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k").cast("string")
    click = F.concat(F.lit('{"a": {"total_s": 1, "l": ['), k, F.lit(', {"avg": "rank"}]}, "t": "{\\"total\\": 1}"}'))
    view = F.concat(F.lit('{"rank": '), k, F.lit(', "b": {"c": {"d": {"e": {"f": [{"mean_x": 1}], "x": 2}}}}}'))
    purchase = F.concat(F.lit('[{"total": 1}, [{"'), F.when(F.col("k") % 2 == 0, "rank_").otherwise("r_"), k, F.lit('": 0}]]'))
    json = F.when(F.col("kind") == "click", click).when(F.col("kind") == "view", view).when(F.col("kind") == "purchase", purchase).otherwise('{"x": [1, 2]}')
    return ev.aggregate_hits(v.v_samples(spark, sf).select(F.col("event_id").alias("doc_id"), json.alias("json")), "^(total|rank|mean|avg)")


ENVELOPE = 'en AS (SELECT job_id, event, min(start) + 0.5 AS b0, max("end") + 0.5 AS b1, min(timeline_start) AS a0, max(timeline_start + duration_s) AS a1 FROM v_cand GROUP BY 1, 2), ev AS (SELECT *, abs(b0 - a0) <= 0.1 AND abs(b1 - a1) <= 0.1 AS agree FROM en)'


@query("evd05_performance_envelope", "v_cand", f", {ENVELOPE} SELECT job_id, event, round(b0, 6) AS b0, round(b1, 6) AS b1, round(a0, 6) AS a0, round(a1, 6) AS a1, agree FROM ev")
def evd05(spark: SparkSession, sf: str) -> DataFrame:
    return r(ev.performance_envelope(v.v_cand(spark, sf), 0.5, 0.1), "b0", "b1", "a0", "a1")


@query("evd06_alignment_failures", "v_cand", f""", {ENVELOPE}, x AS (SELECT c.*, e.a0, e.a1, e.agree, CASE WHEN job_id % 6 <> 0 THEN 500e0 END AS length FROM v_cand c JOIN ev e USING (job_id, event))
SELECT job_id, event, rule, count(*) AS n FROM (SELECT job_id, event, unnest([CASE WHEN abs(timeline_start - start - 0.5) > 0.1 THEN 'invariant' END, CASE WHEN timeline_start < a0 - 1e-6 OR timeline_start + duration_s > a1 + 1e-6 THEN 'outside' END, CASE WHEN NOT agree THEN 'disagree' END, CASE WHEN coalesce("end" > length, true) THEN 'past_reel' END]) AS rule FROM x) WHERE rule IS NOT NULL GROUP BY 1, 2, 3""")
def evd06(spark: SparkSession, sf: str) -> DataFrame:
    c = v.v_cand(spark, sf)
    reels = c.select("job_id").distinct().filter("job_id % 6 <> 0").withColumn("length", F.lit(500.0))
    return ev.alignment_failures(c, ev.performance_envelope(c, 0.5, 0.1), reels, 0.5, 0.1)


@query("evd07_dense_schedule", "v_cand", f", {EVENTS}, w AS (SELECT job_id, event, greatest(anchor - 2, 50) AS a, least(anchor + 2, 600) AS b FROM ea WHERE least(anchor + 2, 600) >= greatest(anchor - 2, 50)), n AS (SELECT *, greatest(1, round_even((b - a) * 2, 0)::INTEGER + 1) AS n FROM w), x AS (SELECT *, unnest(range(0, n)) AS i FROM n) SELECT job_id, event, i::INTEGER AS i, n, round(a + i * (b - a) / greatest(1, n - 1), 6) AS t FROM x")
def evd07(spark: SparkSession, sf: str) -> DataFrame:
    return r(ev.dense_schedule(events(spark, sf), 50.0, 600.0), "t")


@query("evd08_sheet_schedule", "v_cuts", ", s AS (SELECT job_id, min(source_in) AS a, max(source_out) AS b FROM v_cuts GROUP BY 1), n AS (SELECT *, ceil((b - a - 1e-9) / 10)::INTEGER AS n FROM s), x AS (SELECT *, unnest(range(0, (n - 1) // 30 + 1))::INTEGER AS sheet FROM n WHERE n > 0) SELECT job_id, sheet, least(30, n - sheet * 30) AS frames, 30 - least(30, n - sheet * 30) AS padding, round(a + sheet * 300, 6) AS from_s, round(a + (sheet * 30 + least(30, n - sheet * 30) - 1) * 10, 6) AS to_s FROM x")
def evd08(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_cuts(spark, sf).groupBy("job_id").agg(F.min("source_in").alias("a"), F.max("source_out").alias("b"))
    return r(ev.sheet_schedule(s), "from_s", "to_s")


@query("evd10_segment_facts", "v_cuts v_beats v_samples", """, c AS (SELECT job_id, pos, source_in AS a, source_out AS b FROM v_cuts WHERE pos % 4 = 0), s AS (SELECT c.job_id, c.pos, sig FROM c JOIN v_samples x ON x.clip_id = c.job_id AND x.t BETWEEN a - 20 AND b + 20), g AS (SELECT job_id, pos, avg(sig) AS mean, list_sort(list(sig))[round_even((count(*) - 1) * 0.9, 0)::INT + 1] AS p90, max(sig) AS peak FROM s GROUP BY 1, 2)
SELECT c.job_id, c.pos, (SELECT count(*) FROM v_beats b WHERE b.clip_id = c.job_id AND b.t BETWEEN c.a - 20 AND c.b + 20) AS beats, (SELECT count(*) FROM v_beats b WHERE b.clip_id = c.job_id AND b.i % 4 = 0 AND b.t BETWEEN c.a - 20 AND c.b + 20) AS downbeats, round(mean, 9) AS mean, p90, peak FROM c LEFT JOIN g USING (job_id, pos)""")
def evd10(spark: SparkSession, sf: str) -> DataFrame:
    spans = v.v_cuts(spark, sf).filter("pos % 4 = 0").select("job_id", "pos", (F.col("source_in") - 20).alias("a"), (F.col("source_out") + 20).alias("b"))
    beats = v.v_beats(spark, sf).withColumnRenamed("clip_id", "job_id")
    s = v.v_samples(spark, sf).select(F.col("clip_id").alias("job_id"), "t", F.col("sig").alias("v"))
    return r(ev.segment_facts(spans, beats, s), "mean", digits=9)


@query("evd11_cost_rollup", "v_transcript", "SELECT source AS role, count(*) AS n, sum(length(text))::BIGINT AS tokens, round(sum(length(text)) * CASE source WHEN 'user' THEN 3e0 WHEN 'assistant' THEN 15e0 ELSE 0 END / 1e6, 9) AS cost FROM v_transcript GROUP BY 1 UNION ALL SELECT 'all', count(*), sum(length(text))::BIGINT, round(sum(length(text) * CASE source WHEN 'user' THEN 3e0 WHEN 'assistant' THEN 15e0 ELSE 0 END) / 1e6, 9) FROM v_transcript")
def evd11(spark: SparkSession, sf: str) -> DataFrame:
    usage = v.v_transcript(spark, sf).select(F.col("source").alias("role"), F.length("text").alias("tokens"))
    return r(ev.cost_rollup(usage, spark.createDataFrame([("user", 3.0), ("assistant", 15.0)], "role string, per_million double")), "cost", digits=9)


DECISIONS = "de AS (SELECT job_id, event, CASE WHEN rn % 5 = 0 THEN 'HOLD_A' WHEN rn % 7 = 0 THEN 'nope' ELSE candidate_id END AS selection, CASE WHEN rn % 11 = 0 THEN 1.5e0 ELSE score END AS confidence, repeat('x', (rn * 7 % 260)::INT) AS rationale FROM (SELECT job_id, CASE WHEN event = 3 THEN 77 ELSE event END AS event, candidate_id, score, substr(candidate_id, 2)::BIGINT AS rn FROM v_cand) WHERE rn % 3 <> 0)"


def decisions(spark: SparkSession, sf: str) -> DataFrame:
    c = v.v_cand(spark, sf).withColumn("rn", v.cand_number()).filter("rn % 3 <> 0")
    return c.select("job_id", F.when(F.col("event") == 3, 77).otherwise(F.col("event")).alias("event"), F.when(F.col("rn") % 5 == 0, "HOLD_A").when(F.col("rn") % 7 == 0, "nope").otherwise(F.col("candidate_id")).alias("selection"), F.when(F.col("rn") % 11 == 0, 1.5).otherwise(F.col("score")).alias("confidence"), F.expr("repeat('x', cast(rn * 7 % 260 as int))").alias("rationale"))


@query("evd12_validate_decisions", "v_cand", f""", {DECISIONS}, e AS (SELECT DISTINCT job_id, event FROM v_cand)
SELECT job_id, event, 'missing' AS rule FROM e WHERE NOT EXISTS (SELECT 1 FROM de WHERE de.job_id = e.job_id AND de.event = e.event) UNION ALL SELECT DISTINCT job_id, event, 'unknown_event' FROM de WHERE NOT EXISTS (SELECT 1 FROM e WHERE de.job_id = e.job_id AND de.event = e.event)
UNION ALL SELECT job_id, event, 'duplicate' FROM de GROUP BY 1, 2 HAVING count(*) > 1 UNION ALL SELECT job_id, event, 'illegal_selection' FROM de WHERE selection <> 'HOLD_A' AND EXISTS (SELECT 1 FROM e WHERE de.job_id = e.job_id AND de.event = e.event) AND NOT EXISTS (SELECT 1 FROM v_cand c WHERE c.job_id = de.job_id AND c.event = de.event AND c.candidate_id = de.selection)
UNION ALL SELECT job_id, event, 'confidence' FROM de WHERE NOT confidence BETWEEN 0 AND 1 UNION ALL SELECT job_id, event, 'rationale' FROM de WHERE length(rationale) > 240""")
def evd12(spark: SparkSession, sf: str) -> DataFrame:
    return ev.validate_decisions(decisions(spark, sf), v.v_cand(spark, sf))


@query("evd13_resolve_citations", "v_samples v_cand", """, tx AS (SELECT clip_id AS job_id, event_id AS event, 'see ' || (k // 10) || ':' || printf('%02d', k % 60) || '.5 and 9:59' AS text FROM v_samples WHERE kind = 'view'), cd AS (SELECT job_id, event, unnest(regexp_extract_all(text, '\\b(\\d+:\\d{2}(?:\\.\\d+)?)\\b', 1)) AS code, unnest(range(0, len(regexp_extract_all(text, '\\b(\\d+:\\d{2}(?:\\.\\d+)?)\\b', 1))))::INTEGER AS i FROM tx),
ct AS (SELECT *, split_part(code, ':', 1)::DOUBLE * 60 + split_part(code, ':', 2)::DOUBLE AS t FROM cd), h AS (SELECT c.job_id, c.event, c.i, min_by(v.candidate_id, (v.start, v.candidate_id)) AS ev FROM ct c JOIN v_cand v ON v.job_id = c.job_id AND c.t BETWEEN v.start - 0.5 AND v."end" + 0.5 GROUP BY 1, 2, 3)
SELECT c.job_id, c.event, c.i, code, t, coalesce(ev, 'UNRESOLVED') AS evidence FROM ct c LEFT JOIN h USING (job_id, event, i)""")
def evd13(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).filter("kind = 'view'")
    text = F.concat(F.lit("see "), F.floor(F.col("k") / 10).cast("string"), F.lit(":"), F.lpad((F.col("k") % 60).cast("string"), 2, "0"), F.lit(".5 and 9:59"))
    intervals = v.v_cand(spark, sf).select("job_id", F.col("candidate_id").alias("ev_id"), F.col("start").alias("a"), F.col("end").alias("b"))
    return ev.resolve_citations(s.select(F.col("clip_id").alias("job_id"), F.col("event_id").alias("event"), text.alias("text")), intervals)


CHAIN = """ch AS (SELECT job_id, substr(candidate_id, 2)::BIGINT AS event, start AS a, "end" AS b FROM v_cand), co AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY a, event) AS o FROM ch),
wk AS (SELECT job_id, 0::BIGINT AS o, 20e0 AS last, NULL::BIGINT AS event, false AS kept FROM (SELECT DISTINCT job_id FROM co) UNION ALL SELECT w.job_id, c.o, CASE WHEN c.a - w.last >= 12 THEN c.b ELSE w.last END, c.event, c.a - w.last >= 12 FROM wk w JOIN co c ON c.job_id = w.job_id AND c.o = w.o + 1)"""


@query("evd14_materialize_chain", "v_cand", f", {CHAIN} SELECT c.job_id, c.event, c.a, c.b, CASE WHEN w.kept THEN 'kept' ELSE 'forced_hold' END AS state FROM co c JOIN wk w ON w.job_id = c.job_id AND w.o = c.o")
def evd14(spark: SparkSession, sf: str) -> DataFrame:
    c = v.v_cand(spark, sf).select("job_id", v.cand_number().alias("event"), F.col("start").alias("a"), F.col("end").alias("b"))
    return ev.materialize_chain(c, 20.0, 12.0)


@query("evd15_compare_decisions", "v_samples", """, s AS (SELECT clip_id AS job_id, kind, row_number() OVER (PARTITION BY clip_id, kind ORDER BY t) AS event, CASE WHEN k % 4 = 0 THEN 'HOLD_A' ELSE 'c' || k % 3 END AS selection, sig / 500 AS confidence FROM v_samples WHERE kind IN ('view', 'click'))
SELECT a.job_id, count(*) AS n, count(*) FILTER (WHERE a.selection <> b.selection) AS changed, count(*) FILTER (WHERE b.confidence > a.confidence) AS up, count(*) FILTER (WHERE b.confidence < a.confidence) AS down, count(*) FILTER (WHERE a.selection = 'HOLD_A') AS holds_a, count(*) FILTER (WHERE b.selection = 'HOLD_A') AS holds_b FROM s a JOIN s b ON a.job_id = b.job_id AND a.event = b.event AND a.kind = 'view' AND b.kind = 'click' GROUP BY 1""")
def evd15(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf).filter("kind in ('view', 'click')").withColumn("event", F.row_number().over(Window.partitionBy("clip_id", "kind").orderBy("t")))
    s = s.select(F.col("clip_id").alias("job_id"), "kind", "event", F.when(F.col("k") % 4 == 0, "HOLD_A").otherwise(F.concat(F.lit("c"), F.col("k") % 3)).alias("selection"), (F.col("sig") / 500).alias("confidence"))
    return ev.compare_decisions(s.filter("kind = 'view'").drop("kind"), s.filter("kind = 'click'").drop("kind"))


@query("evd16_topic_rates", "v_transcript", "SELECT source AS grp, count(*) AS n, round(count(*) FILTER (WHERE regexp_matches(text, '(?i)the')) / count(*), 9) AS article, round(count(*) FILTER (WHERE regexp_matches(text, '(?i)ing\\b')) / count(*), 9) AS gerund FROM v_transcript GROUP BY 1")
def evd16(spark: SparkSession, sf: str) -> DataFrame:
    return r(ev.topic_rates(v.v_transcript(spark, sf).withColumnRenamed("source", "grp"), {"article": "(?i)the", "gerund": r"(?i)ing\b"}), "article", "gerund", digits=9)


@query("evd17_decision_distribution", "v_cuts", "SELECT angle AS side, count(*) AS n, round(min(source_out - source_in), 6) AS least, round(median(source_out - source_in), 6) AS median, round(avg(source_out - source_in), 6) AS mean, round(max(source_out - source_in), 6) AS most, count(*) FILTER (WHERE source_out - source_in >= 30) AS at_ceiling, round(avg(pos % 10 / 10e0), 6) AS confidence FROM v_cuts GROUP BY 1")
def evd17(spark: SparkSession, sf: str) -> DataFrame:
    c = v.v_cuts(spark, sf).select(F.col("angle").alias("side"), (F.col("source_out") - F.col("source_in")).alias("duration_s"), (F.col("pos") % 10 / 10.0).alias("confidence"))
    return r(ev.decision_distribution(c, 30.0), "least", "median", "mean", "most", "confidence")


@query("evd18_ground_claims", "v_samples", """, f AS (SELECT clip_id AS job_id, k // 25 AS event, CASE WHEN kind IN ('view', 'click', 'signup') THEN 'A' ELSE 'B' END AS angle, event_id, sig, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY clip_id, k // 25, CASE WHEN kind IN ('view', 'click', 'signup') THEN 'A' ELSE 'B' END) AS n FROM v_samples WINDOW w AS (PARTITION BY clip_id, k // 25, CASE WHEN kind IN ('view', 'click', 'signup') THEN 'A' ELSE 'B' END ORDER BY event_id)),
g AS (SELECT job_id, event, avg(sig) FILTER (WHERE angle = 'A') AS a, avg(sig) FILTER (WHERE angle = 'B') AS b FROM f WHERE i % greatest(1, n // 5) = 0 GROUP BY 1, 2)
SELECT job_id, event, round(a, 9) AS a, round(b, 9) AS b, CASE WHEN a IS NULL OR b IS NULL THEN 'unmeasured' WHEN b < a - 2 THEN 'darker' WHEN b > a + 2 THEN 'brighter' ELSE 'equal' END AS verdict FROM g WHERE job_id % 3 = 0""")
def evd18(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf)
    f = s.select(F.col("clip_id").alias("job_id"), F.floor(F.col("k") / 25).cast("int").alias("event"), F.when(F.col("kind").isin("view", "click", "signup"), "A").otherwise("B").alias("angle"), F.col("event_id").alias("k"), F.col("sig").alias("luma"))
    claims = f.select("job_id", "event").distinct().withColumn("text", F.when(F.col("job_id") % 3 == 0, "too Dark here").otherwise("fine"))
    return r(ev.ground_claims(f, claims), "a", "b", digits=9)


@query("evd19_legality", "v_cand", """, x AS (SELECT *, lag(duration_s) OVER (PARTITION BY job_id, event ORDER BY candidate_id) AS p FROM v_cand)
SELECT job_id, event, count(*) AS n, bool_and(duration_s BETWEEN 5 AND 13) AS length_ok, bool_and("end" > start) AS order_ok, bool_and(abs(timeline_start - start - 0.5) <= 0.2) AS sync_ok, count(DISTINCT candidate_id) = count(*) AS ids_ok, bool_and(coalesce(duration_s >= p, true)) AS ladder_ok FROM x GROUP BY 1, 2""")
def evd19(spark: SparkSession, sf: str) -> DataFrame:
    return ev.legality(v.v_cand(spark, sf), least=5.0, most=13.0, lag=0.5, tolerance=0.2)


@query("evd20_artifact_diff", "v_cand", """, o AS (SELECT job_id, candidate_id, start FROM v_cand WHERE substr(candidate_id, 2)::INT % 7 <> 0), n AS (SELECT job_id, candidate_id, start + substr(candidate_id, 2)::INT % 5 AS start FROM v_cand WHERE substr(candidate_id, 2)::INT % 5 <> 1), x AS (SELECT job_id, o.start AS a, n.start AS b FROM o FULL JOIN n USING (job_id, candidate_id))
SELECT job_id, count(abs(b - a)) AS "both", count(*) FILTER (WHERE b IS NULL) AS only_old, count(*) FILTER (WHERE a IS NULL) AS only_new, round(avg(abs(b - a)), 6) AS mean, round(quantile_cont(abs(b - a), 0.9), 6) AS p90, round(max(abs(b - a)), 6) AS most FROM x GROUP BY 1""")
def evd20(spark: SparkSession, sf: str) -> DataFrame:
    c = v.v_cand(spark, sf).withColumn("n", v.cand_number())
    return r(ev.artifact_diff(c.filter("n % 7 <> 0"), c.filter("n % 5 <> 1").withColumn("start", F.col("start") + F.col("n") % 5)), "mean", "p90", "most")


@query("evd21_parse_decisions", "v_samples", "SELECT event_id AS doc_id, CASE kind WHEN 'click' THEN 'list' WHEN 'view' THEN 'decisions' ELSE 'chain' END AS form, 0 AS i, 'ev' || k AS event_id, 'HOLD_A' AS selection FROM v_samples WHERE kind IN ('click', 'view', 'signup')")
def evd21(spark: SparkSession, sf: str) -> DataFrame:
    one = F.concat(F.lit('[{"event_id": "ev'), F.col("k").cast("string"), F.lit('", "selection": "HOLD_A"}]'))
    text = F.when(F.col("kind") == "click", F.concat(F.lit("Here:\n```json\n"), one, F.lit("\n```"))).when(F.col("kind") == "view", F.concat(F.lit('{"decisions": '), one, F.lit("}"))).when(F.col("kind") == "signup", F.concat(F.lit('```\n{"chain": '), one, F.lit("}\n```\nDone."))).otherwise(F.lit("none {broken"))
    return ev.parse_decisions(v.v_samples(spark, sf).select(F.col("event_id").alias("doc_id"), text.alias("text")))
