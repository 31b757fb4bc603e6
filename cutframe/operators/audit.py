"""Opportunity and coverage audit: opps(job_id, opp, t0, t1, peak) against candidates(job_id, candidate_id, start, end, event)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import islands, nearest, overlap


def event_faces(cands: DataFrame) -> DataFrame:
    """Per event the envelope of its candidates."""
    return cands.groupBy("job_id", "event").agg(F.min("start").alias("face_start"), F.max("end").alias("face_end"), F.count("*").alias("n"))


def best_overlap(opps: DataFrame, cands: DataFrame) -> DataFrame:
    """Per opportunity: the candidate with most overlap (earliest start of equals), the fraction covered, entry delta, latest exit among overlapping, and overlapping events; nulls where missed."""
    c = cands.select("job_id", "candidate_id", F.col("start").alias("c0"), F.col("end").alias("c1"), "event")
    met = overlap(opps, c, "job_id", ("t0", "t1"), ("c0", "c1"), 16.0)
    span = F.least("t1", "c1") - F.greatest("t0", "c0")
    met = met.withColumn("frac", F.round(span / (F.col("t1") - F.col("t0")), 9))
    g = met.groupBy("job_id", "opp").agg(F.min_by(F.struct("candidate_id", "frac", (F.col("c0") - F.col("t0")).alias("delta")), F.struct(-F.col("frac"), "c0", "candidate_id")).alias("b"), F.max("c1").alias("best_exit"), F.array_join(F.array_sort(F.collect_set(F.col("event").cast("string"))), ",").alias("events"))
    out = opps.join(g, ["job_id", "opp"], "left")
    return out.select("job_id", "opp", "t0", "t1", "peak", F.col("b.candidate_id").alias("candidate_id"), F.coalesce("b.frac", F.lit(0.0)).alias("frac"), F.col("b.delta").alias("delta"), "best_exit", F.coalesce("events", F.lit("")).alias("events"))


def classify_v1(best: DataFrame) -> DataFrame:
    """MISSED under a quarter covered; PARTIAL under 0.8 or with an entry outside [-2, 1] seconds; else COVERED."""
    return best.withColumn("cls", F.when(F.col("frac") < 0.25, "MISSED").when((F.col("frac") < 0.8) | (F.col("delta") < -2) | (F.col("delta") > 1), "PARTIAL").otherwise("COVERED"))


def classify_v2(opps: DataFrame, cands: DataFrame, near: float = 2.0, exit_: float = 1.0) -> DataFrame:
    """COVERED if a candidate enters within `near` of t0 and leaves no sooner than t1 - exit_; PARTIAL if any overlaps; with diagnostic flags."""
    c = cands.select("job_id", "candidate_id", F.col("start").alias("c0"), F.col("end").alias("c1"))
    o = opps.withColumns({"_a": F.col("t0") - near, "_b": F.greatest(F.col("t1"), F.col("t0") + near)})
    met = overlap(o, c, "job_id", ("_a", "_b"), ("c0", "c1"), 16.0, closed=True)
    enters = F.abs(F.col("c0") - F.col("t0")) <= near
    lasts = F.col("c1") >= F.col("t1") - exit_
    crosses = F.least("t1", "c1") > F.greatest("t0", "c0")
    g = met.groupBy("job_id", "opp").agg(F.bool_or(enters & lasts).alias("covered"), F.bool_or(crosses).alias("some"), F.bool_or(crosses & (F.col("c0") < F.col("t0") - near)).alias("straddle"), F.bool_or(crosses & (F.col("c0") > F.col("t0") + near)).alias("late"), F.bool_or(enters & ~lasts).alias("short_exit"))
    out = opps.join(g, ["job_id", "opp"], "left")
    no = lambda c: F.coalesce(c, F.lit(False))
    flags = F.array_join(F.filter(F.array(F.when(no(F.col("straddle")), "straddle"), F.when(no(F.col("late")) & ~no(F.col("covered")), "only_late"), F.when(no(F.col("short_exit")) & ~no(F.col("covered")), "short_exit")), lambda x: x.isNotNull()), ",")
    return out.select("job_id", "opp", F.when(no(F.col("covered")), "COVERED").when(no(F.col("some")), "PARTIAL").otherwise("MISSED").alias("cls"), flags.alias("flags"))


def coverage_summary(classified: DataFrame) -> DataFrame:
    """Per job: counts by class, strict rate, and the rate with PARTIAL as a half."""
    n = lambda c: F.count_if(F.col("cls") == c)
    return classified.groupBy("job_id").agg(F.count("*").alias("n"), n("COVERED").alias("covered"), n("PARTIAL").alias("partial"), n("MISSED").alias("missed"), (n("COVERED") / F.count("*")).alias("strict"), ((n("COVERED") + 0.5 * n("PARTIAL")) / F.count("*")).alias("weighted"))


def interval_union(intervals: DataFrame) -> DataFrame:
    """Merged intervals (job_id, a, b); touching ones merge."""
    w = Window.partitionBy("job_id").orderBy("a", "b")
    before = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return islands(intervals, ["job_id"], ["a", "b"], F.col("a") > before, "u").groupBy("job_id", "u").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("u")


def holes(intervals: DataFrame, ranges: DataFrame) -> DataFrame:
    """What the union leaves open in each job's range (job_id, lo, hi)."""
    u = interval_union(intervals).join(ranges, "job_id").withColumns({"a": F.greatest("a", "lo"), "b": F.least("b", "hi")}).filter("a < b")
    w = Window.partitionBy("job_id").orderBy("a")
    inner = u.select("job_id", F.coalesce(F.lag("b").over(w), F.col("lo")).alias("h0"), F.col("a").alias("h1"))
    last = u.groupBy("job_id").agg(F.max("b").alias("h0"), F.first("hi").alias("h1"))
    none = ranges.join(u, "job_id", "left_anti").select("job_id", F.col("lo").alias("h0"), F.col("hi").alias("h1"))
    return inner.unionByName(last).unionByName(none).filter("h1 > h0")


def hole_activity(holes_: DataFrame, series: DataFrame) -> DataFrame:
    """Per hole (job_id, h0, h1): samples, mean, peak, and the share of the job's samples below the mean and below the peak."""
    s = series.withColumn("t2", F.col("t"))
    met = overlap(holes_, s, "job_id", ("h0", "h1"), ("t", "t2"), 16.0, closed=True)
    g = met.groupBy("job_id", "h0", "h1").agg(F.count("*").alias("n"), F.round(F.avg("v"), 9).alias("mean"), F.max("v").alias("peak"))
    base = series.select("job_id", F.col("v").alias("x"))
    rank = g.join(base, "job_id").groupBy("job_id", "h0", "h1").agg((F.count_if(F.col("x") < F.col("mean")) / F.count("*")).alias("mean_rank"), (F.count_if(F.col("x") < F.col("peak")) / F.count("*")).alias("peak_rank"))
    return g.join(rank, ["job_id", "h0", "h1"])


def poorly_covered(runs: DataFrame, cands: DataFrame, most: float = 0.25) -> DataFrame:
    """Runs (job_id, opp, t0, t1, peak) whose best candidate covers less than `most`."""
    return best_overlap(runs, cands).filter(F.col("frac") < most)


def opportunity_detail(opps: DataFrame, cands: DataFrame, near: float = 1.0) -> DataFrame:
    """Every overlapping candidate with its entry and exit offsets; near_onset and full_service."""
    c = cands.select("job_id", "candidate_id", F.col("start").alias("c0"), F.col("end").alias("c1"))
    met = overlap(opps, c, "job_id", ("t0", "t1"), ("c0", "c1"), 16.0)
    e, x = F.col("c0") - F.col("t0"), F.col("c1") - F.col("t1")
    return met.select("job_id", "opp", "candidate_id", e.alias("entry"), x.alias("exit"), (F.abs(e) <= near).alias("near_onset"), ((F.abs(e) <= near) & (x >= -near)).alias("full_service"))


def counterpart_peak(points: DataFrame, series: DataFrame, half: float = 2.0) -> DataFrame:
    """The greatest value of another camera's series (job_id, t, v) within half of each point (job_id, opp, peak)."""
    p = points.select("job_id", "opp", "peak").withColumns({"_a": F.col("peak") - half, "_b": F.col("peak") + half})
    met = overlap(p, series.withColumn("t2", F.col("t")), "job_id", ("_a", "_b"), ("t", "t2"), 16.0, closed=True)
    g = met.groupBy("job_id", "opp").agg(F.max("v").alias("counterpart"))
    return p.select("job_id", "opp").join(g, ["job_id", "opp"], "left")


def nearest_event(opps: DataFrame, events: DataFrame) -> DataFrame:
    """The event (job_id, event, anchor) nearest to each opportunity's peak."""
    return nearest(opps.select("job_id", "opp", "peak"), events.select("job_id", F.col("anchor").alias("at"), "event"), "job_id", "peak", "at", ["event"])
