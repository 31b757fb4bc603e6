"""ACT rows, over smoothed samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import activity as ac
from ..operators.signals import smooth_same
from ..sources import views as v
from . import query
from .timeline import r

SERIES = "se AS (SELECT clip_id, row_number() OVER w - 1 AS n, round(sum(sig) OVER (PARTITION BY clip_id ORDER BY t ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5, 6) AS sm, k::DOUBLE AS luma, sig / 50 AS glob FROM v_samples WINDOW w AS (PARTITION BY clip_id ORDER BY t))"
PEAKS = "pk AS (SELECT clip_id, n, sm AS pk, med, l FROM (SELECT *, max(sm) OVER (PARTITION BY clip_id ORDER BY n ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS mx, median(sm) OVER (PARTITION BY clip_id) AS med, max(n) OVER (PARTITION BY clip_id) AS l FROM se) WHERE sm = mx AND n >= 2 AND n < l - 1 AND sm >= med)"
RUNS = """ex AS (SELECT p.clip_id, p.n, p.pk, greatest(p.pk * 0.5, p.med) AS flr, p.l, max(s.n) FILTER (WHERE s.sm <= greatest(p.pk * 0.5, p.med) AND s.n < p.n) AS a, min(s.n) FILTER (WHERE s.sm <= greatest(p.pk * 0.5, p.med) AND s.n > p.n) AS b FROM pk p JOIN se s ON s.clip_id = p.clip_id GROUP BY ALL),
e2 AS (SELECT *, coalesce(a + 1, 0) AS lo0, coalesce(b - 1, l) AS hi0 FROM ex),
rn AS (SELECT clip_id, n, pk, flr, CASE WHEN hi0 + 1 - lo0 > 12 THEN greatest(0, n - 6) ELSE lo0 END AS lo, CASE WHEN hi0 + 1 - lo0 > 12 THEN least(l, n + 6) ELSE hi0 END AS hi, hi0 + 1 - lo0 > 12 AS capped FROM e2)"""
NMS = """od AS (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY pk DESC, n) AS o FROM rn WHERE hi + 1 - lo >= 2),
wk AS (SELECT clip_id, 0::BIGINT AS o, []::STRUCT(n BIGINT, lo BIGINT, hi BIGINT)[] AS ks FROM (SELECT DISTINCT clip_id FROM od)
 UNION ALL SELECT w.clip_id, d.o, CASE WHEN len(list_filter(ks, lambda x: (d.lo < x.hi AND d.hi > x.lo) OR abs(d.lo - x.lo) < 4)) = 0 THEN list_append(ks, {'n': d.n, 'lo': d.lo, 'hi': d.hi}) ELSE ks END FROM wk w JOIN od d ON d.clip_id = w.clip_id AND d.o = w.o + 1),
kn AS (SELECT clip_id, unnest(max_by(ks, o)) AS x FROM wk GROUP BY 1), nm AS (SELECT rn.* FROM rn JOIN kn ON kn.clip_id = rn.clip_id AND kn.x.n = rn.n)"""


def series(spark: SparkSession, sf: str) -> DataFrame:
    s = v.v_samples(spark, sf)
    s = s.withColumns({"n": F.row_number().over(Window.partitionBy("clip_id").orderBy("t")) - 1, "luma": F.col("k").cast("double"), "glob": F.col("sig") / 50})
    return r(smooth_same(s, "sig", "t").select("clip_id", "n", "sm", "luma", "glob"), "sm")


def runs(spark: SparkSession, sf: str) -> DataFrame:
    s = series(spark, sf)
    return ac.expand_runs(ac.local_peaks(s), s, 0.5, 12)


@query("act01_local_peaks", "v_samples", f", {SERIES}, {PEAKS} SELECT clip_id, n, pk, round(med, 6) AS med FROM pk")
def act01(spark: SparkSession, sf: str) -> DataFrame:
    return r(ac.local_peaks(series(spark, sf)).drop("_last"), "med")


@query("act02_expand_runs", "v_samples", f", {SERIES}, {PEAKS}, {RUNS} SELECT clip_id, n, pk, lo, hi, capped FROM rn")
def act02(spark: SparkSession, sf: str) -> DataFrame:
    return runs(spark, sf).drop("floor")


@query("act03_nms_runs", "v_samples", f", {SERIES}, {PEAKS}, {RUNS}, {NMS} SELECT clip_id, n, pk, lo, hi, capped FROM nm")
def act03(spark: SparkSession, sf: str) -> DataFrame:
    return ac.nms_runs(runs(spark, sf), 4, 2).drop("floor")


DESCRIBED = """ds AS (SELECT m.clip_id, m.n, m.pk, m.lo, m.hi, sum(s.sm - m.flr) AS mass, avg(s.luma) AS luma_mean, min(s.luma) AS luma_min, count(*) FILTER (WHERE s.glob < 0.35) / count(*) AS frozen_frac FROM nm m JOIN se s ON s.clip_id = m.clip_id AND s.n BETWEEN m.lo AND m.hi GROUP BY ALL),
de AS (SELECT d.*, (SELECT 100 * count(*) FILTER (WHERE s.sm < d.pk) / count(*) FROM se s WHERE s.clip_id = d.clip_id) AS strength_pct, printf('run_%02d', row_number() OVER (PARTITION BY clip_id ORDER BY lo, n)) AS run_id FROM ds d)"""


@query("act04_describe_runs", "v_samples", f", {SERIES}, {PEAKS}, {RUNS}, {NMS}, {DESCRIBED} SELECT clip_id, n, pk, lo, hi, round(mass, 5) AS mass, round(luma_mean, 9) AS luma_mean, luma_min, round(frozen_frac, 9) AS frozen_frac, round(strength_pct, 9) AS strength_pct, run_id FROM de")
def act04(spark: SparkSession, sf: str) -> DataFrame:
    d = ac.describe_runs(ac.nms_runs(runs(spark, sf), 4, 2), series(spark, sf))
    return r(r(d, "luma_mean", "frozen_frac", "strength_pct", digits=9), "mass", digits=5)


@query("act05_mad_episodes", "v_samples", f""", {SERIES}, md AS (SELECT clip_id, median(sm) AS med FROM se GROUP BY 1), th AS (SELECT clip_id, any_value(med) + 1 * (median(abs(sm - med)) * 1.4826::DOUBLE) AS thr FROM se JOIN md USING (clip_id) GROUP BY 1),
ab AS (SELECT se.*, thr, CASE WHEN n - lag(n) OVER (PARTITION BY clip_id ORDER BY n) <= 2 THEN 0 ELSE 1 END AS new FROM se JOIN th USING (clip_id) WHERE sm > thr), ep AS (SELECT *, sum(new) OVER (PARTITION BY clip_id ORDER BY n) AS ep FROM ab),
bd AS (SELECT clip_id, ep, min(n) AS lo, max(n) AS hi, any_value(thr) AS thr FROM ep GROUP BY 1, 2), es AS (SELECT b.clip_id, lo, hi, round(sum(sm - b.thr), 6) AS mass, min_by(s.n, (-s.sm, s.n)) AS peak FROM bd b JOIN se s ON s.clip_id = b.clip_id AND s.n BETWEEN lo AND hi WHERE hi - lo + 1 >= 2 GROUP BY ALL),
od AS (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY mass DESC, lo) AS o FROM es),
wk AS (SELECT clip_id, 0::BIGINT AS o, []::BIGINT[] AS ks FROM (SELECT DISTINCT clip_id FROM od) UNION ALL SELECT w.clip_id, d.o, CASE WHEN len(ks) < 12 AND len(list_filter(ks, lambda x: abs(x - d.peak) < 8)) = 0 THEN list_append(ks, d.peak) ELSE ks END FROM wk w JOIN od d ON d.clip_id = w.clip_id AND d.o = w.o + 1),
f AS (SELECT clip_id, unnest(max_by(ks, o)) AS peak FROM wk GROUP BY 1) SELECT od.clip_id, lo, hi, mass, od.peak FROM od JOIN f ON f.clip_id = od.clip_id AND f.peak = od.peak""")
def act05(spark: SparkSession, sf: str) -> DataFrame:
    return ac.mad_episodes(series(spark, sf), k=1.0)


PEAK_EP = f"""od AS (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY pk DESC, n) AS o FROM pk),
wk AS (SELECT clip_id, 0::BIGINT AS o, []::BIGINT[] AS ks FROM (SELECT DISTINCT clip_id FROM od) UNION ALL SELECT w.clip_id, d.o, CASE WHEN len(ks) < 12 AND len(list_filter(ks, lambda x: abs(x - d.n) < 15)) = 0 THEN list_append(ks, d.n) ELSE ks END FROM wk w JOIN od d ON d.clip_id = w.clip_id AND d.o = w.o + 1),
kp AS (SELECT clip_id, unnest(max_by(ks, o)) AS n FROM wk GROUP BY 1), p2 AS (SELECT pk.* FROM pk JOIN kp USING (clip_id, n)),
{RUNS.replace("FROM pk p", "FROM p2 p").replace("p.pk * 0.5", "p.pk * 0.6::DOUBLE").replace("> 12", "> 64").replace("n - 6)", "n - 32)").replace("n + 6)", "n + 32)")},
g AS (SELECT r.clip_id, r.n, lo, hi, round(sum(s.sm - flr), 6) AS mass FROM rn r JOIN se s ON s.clip_id = r.clip_id AND s.n BETWEEN lo AND hi GROUP BY ALL)"""


@query("act06_peak_episodes", "v_samples", f", {SERIES}, {PEAKS}, {PEAK_EP} SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY mass DESC, n) AS rank FROM g")
def act06(spark: SparkSession, sf: str) -> DataFrame:
    return ac.peak_episodes(series(spark, sf))


@query("act07_consensus", "v_samples", """, e AS (SELECT clip_id, kind AS metric, t AS t0, t + k / 10e0 AS t1, t + k / 20e0 AS peak FROM v_samples), b AS (SELECT *, max(peak) OVER (PARTITION BY clip_id ORDER BY peak, metric, t0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM e),
c AS (SELECT *, sum(CASE WHEN peak > before + 6 OR before IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY clip_id ORDER BY peak, metric, t0)::BIGINT AS cluster FROM b)
SELECT clip_id, cluster, count(DISTINCT metric) AS votes, count(*) AS n, round(median(t0), 6) AS t0, round(median(t1), 6) AS t1, round(median(peak), 6) AS peak FROM c GROUP BY 1, 2 HAVING count(DISTINCT metric) >= 2""")
def act07(spark: SparkSession, sf: str) -> DataFrame:
    e = v.v_samples(spark, sf).select("clip_id", F.col("kind").alias("metric"), F.col("t").alias("t0"), (F.col("t") + F.col("k") / 20.0).alias("peak"), (F.col("t") + F.col("k") / 10.0).alias("t1"))
    return r(ac.consensus(e), "t0", "t1", "peak")
