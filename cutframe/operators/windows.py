"""Source-window search and onset proposals: what is stateless runs in parallel, only the sequential rules walk a job's slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import apart, greedy, nearest, overlap

def best_windows(slots: DataFrame, segs: DataFrame, *, least: float, most: float, step: float = 1.0) -> DataFrame:
    """One window per slot (job_id, slot, lo, hi), in slot order, by the mean score (0 or more) of the segments (job_id, s0, s1, score) under it.

    Starts go by `step`, lengths from least to most by 1. A slot takes the best free window that starts at or after the end of all
    windows chosen before (state 'ordered', starts counted from there); else the best free one ('unordered'); else the best of the longest windows
    of each start, whether free or not ('reused'). Of equals the earliest, then the shortest. Only a slot shorter than least has 'none'.
    Score is null where no segment lies under the window.

    Slots meet their segments in one join; a job's slots, each with its few segments, are then folded in order inside the JVM.
    """
    met = overlap(slots, segs, "job_id", ("lo", "hi"), ("s0", "s1"), 16.0).groupBy("job_id", "slot").agg(F.array_sort(F.collect_list(F.struct("s0", "s1", "score"))).alias("segs"))
    rows = slots.filter(F.col("hi") - F.col("lo") >= least - 1e-9).join(met, ["job_id", "slot"], "left")
    none = F.array().cast(met.schema["segs"].dataType)
    jobs = rows.groupBy("job_id").agg(F.array_sort(F.collect_list(F.struct("slot", "lo", "hi", F.coalesce("segs", none).alias("segs")))).alias("slots"))

    def starts(x: Column, first: Column) -> Column:
        n = F.floor((x["hi"] - least - first + 1e-9) / step)
        return F.transform(F.when(n >= 0, F.sequence(F.lit(0).cast("bigint"), n)).otherwise(F.array().cast("array<bigint>")), lambda i: first + i * step)

    def windows(x: Column, first: Column) -> Column:
        more = lambda a: F.greatest(F.lit(0).cast("bigint"), F.floor(F.least(F.lit(most), x["hi"] - a) - least + 1e-9))
        return F.flatten(F.transform(starts(x, first), lambda a: F.transform(F.sequence(F.lit(0).cast("bigint"), more(a)), lambda n: F.struct(a.alias("w0"), (a + least + n).alias("w1")))))

    def free(kept: Column, spans: Column) -> Column:
        return F.filter(spans, lambda y: ~F.exists(kept, lambda u: (y["w0"] < u["w1"]) & (y["w1"] > u["w0"])))

    def best(x: Column, spans: Column, state: str) -> Column:
        def loss(y: Column) -> Column:
            shared = lambda u: F.greatest(F.lit(0.0), F.least(y["w1"], u["s1"]) - F.greatest(y["w0"], u["s0"]))
            total = F.aggregate(x["segs"], F.lit(0.0), lambda t, u: t + u["score"] * shared(u))
            return -F.round(F.coalesce(F.try_divide(total, F.aggregate(x["segs"], F.lit(0.0), lambda t, u: t + shared(u))), F.lit(-1.0)), 6)

        return F.array_min(F.transform(spans, lambda y: F.struct(loss(y).alias("loss"), y["w0"].alias("w0"), y["w1"].alias("w1"), F.lit(state).alias("state"))))

    def choose(kept: Column, x: Column) -> Column:
        after = F.greatest(x["lo"], F.array_max(F.transform(kept, lambda u: u["w1"])))
        longest = F.transform(starts(x, x["lo"]), lambda a: F.struct(a.alias("w0"), F.least(a + most, x["hi"]).alias("w1")))
        chosen = F.coalesce(best(x, free(kept, windows(x, after)), "ordered"), best(x, free(kept, windows(x, x["lo"])), "unordered"), best(x, longest, "reused"))
        score = lambda m: F.when(m["loss"] <= 0, -m["loss"]).alias("score")
        return F.concat(kept, F.transform(F.array(chosen), lambda m: F.struct(x["slot"].alias("slot"), m["w0"].alias("w0"), m["w1"].alias("w1"), score(m), m["state"].alias("state"))))

    kind = f"array<struct<slot: {slots.schema['slot'].dataType.simpleString()}, w0: double, w1: double, score: double, state: string>>"
    found = jobs.select("job_id", F.inline(F.aggregate("slots", F.array().cast(kind), choose)))
    return slots.select("job_id", "slot").join(found, ["job_id", "slot"], "left").withColumn("state", F.coalesce("state", F.lit("none")))


def centered_window(slots: DataFrame, segs: DataFrame, *, duration: float, step: float = 0.5) -> DataFrame:
    """Per slot (job_id, slot, lo, hi, center): the window start in [lo, hi] with the greatest score - 0.25 |start - center| / span, the earliest of equals."""
    rows = slots.filter("hi >= lo").withColumn("i", F.explode(F.sequence(F.lit(0), F.floor((F.col("hi") - F.col("lo") + 1e-6) / step).cast("int"))))
    rows = rows.withColumn("w0", F.col("lo") + F.col("i") * step).withColumn("w1", F.col("w0") + duration)
    met = overlap(rows.select("job_id", "slot", "i", "w0", "w1"), segs, "job_id", ("w0", "w1"), ("s0", "s1"), 16.0)
    score = F.sum(F.col("score") * (F.least("w1", "s1") - F.greatest("w0", "s0"))) / duration
    action = met.groupBy("job_id", "slot", "i").agg(score.alias("action"))
    full = rows.join(action, ["job_id", "slot", "i"], "left")
    value = F.round(F.coalesce("action", F.lit(0.0)) - 0.25 * F.abs(F.col("w0") - F.col("center")) / F.greatest(F.col("hi") - F.col("lo"), F.lit(1.0)), 6)
    return full.withColumn("value", value).groupBy("job_id", "slot").agg(F.min_by(F.struct("w0", "w1"), F.struct(-F.col("value"), "i")).alias("b"), F.max("value").alias("value")).select("job_id", "slot", "b.w0", "b.w1", "value")


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def path_scores(path: DataFrame, *, recovery: float, novelty_cap: float) -> DataFrame:
    """continuity and novelty of each event on the canonical path (job_id, event, t0, t1, s0, s1): by the gap to the previous exit and the order of source material."""
    w = Window.partitionBy("job_id").orderBy("t0", "event")
    gap = F.col("t0") - F.lag("t1").over(w)
    ordered = F.col("s0") >= F.lag("s1").over(w) - 1e-9
    rows = path.withColumns({"gap": gap, "ordered": ordered})
    rec = clamp01(F.col("gap") / recovery)
    continuity = F.when(F.col("gap").isNull(), F.lit(1.0)).when((F.col("gap") >= recovery - 1e-9) & F.col("ordered"), F.lit(1.0)).when(~F.col("ordered"), F.least(rec, F.lit(0.25))).otherwise(rec)
    return rows.select("job_id", "event", F.round(continuity, 6).alias("continuity"), F.round(clamp01(F.coalesce("gap", "t0") / novelty_cap), 6).alias("novelty"))


def propose_onsets(runs: DataFrame, beats: DataFrame, taken: DataFrame, reels: DataFrame, *, min_len: float, snap: float, gap: float, darkest: float, frozen: float) -> DataFrame:
    """One decision and reason per run (job_id, run_id, onset, end, strength, luma_min, frozen_frac), strongest first.

    The stateless reasons are ordered: too short, no beat within `snap`, past the reel (job_id, length), dark, frozen, already represented by
    an interval in taken (job_id, a, b); what is left must keep `gap` to the proposals before it.
    """
    rows = nearest(runs, beats, "job_id", "onset", "t").withColumn("at", F.col("near_t")).join(reels, "job_id", "left")
    point = rows.filter("at is not null").select("job_id", "run_id", "at").withColumn("at2", F.col("at"))
    known = overlap(point, taken, "job_id", ("at", "at2"), ("a", "b"), 16.0, closed=True).select("job_id", "run_id").distinct().withColumn("_known", F.lit(True))
    rows = rows.join(known, ["job_id", "run_id"], "left")
    reason = (
        F.when(F.col("end") - F.col("onset") < min_len, "too_short")
        .when(F.coalesce(F.abs(F.col("at") - F.col("onset")) > snap, F.lit(True)), "no_beat")
        .when(F.coalesce(F.col("end") > F.col("length"), F.lit(True)), "past_reel")
        .when(F.col("luma_min") < darkest, "dark")
        .when(F.col("frozen_frac") > frozen, "frozen")
        .when(F.col("_known"), "represented")
    )
    rows = rows.withColumn("reason", reason)
    pool = rows.filter("reason is null")
    pool = apart(pool, ["job_id"], F.col("at"), F.col("at") + gap, ["run_id"])
    kept = greedy(pool, ["job_id", "_part"], [("strength", True), ("run_id", False)], ["run_id", "at"], lambda k, x: F.forall(k, lambda u: F.abs(u["at"] - x["at"]) >= gap))
    kept = kept.select("job_id", "run_id").withColumn("_kept", F.lit(True))
    out = rows.join(kept, ["job_id", "run_id"], "left")
    return out.select("job_id", "run_id", F.when(F.col("reason").isNotNull(), F.col("reason")).when(F.col("_kept"), "proposed").otherwise("min_gap").alias("decision"), F.when(F.col("_kept"), F.col("at")).alias("at"))


def validate_promotions(promotions: DataFrame, offers: DataFrame, bounds: DataFrame, *, least: float, most: float, ceiling: int, recovery: float) -> DataFrame:
    """job_id, candidate_id (null for a whole job), rule: not offered, duration outside policy, too many, short recovery, straddling a processing boundary.

    promotions(job_id, candidate_id, decision, duration_s), offers(job_id, candidate_id, anchor), bounds(job_id, b)
    """
    decision = promotions.filter(~F.col("decision").isin("KEEP_A_RUN", "PROMOTE")).select("job_id", "candidate_id", F.lit("decision").alias("rule"))
    unknown = promotions.join(offers, ["job_id", "candidate_id"], "left_anti").select("job_id", "candidate_id", F.lit("not_offered").alias("rule"))
    known = promotions.join(offers, ["job_id", "candidate_id"])
    fine = F.col("duration_s").between(least - 1e-6, most + 1e-6)
    length = known.filter(~fine).select("job_id", "candidate_id", F.lit("duration").alias("rule"))
    good = known.filter(fine).withColumn("stop", F.col("anchor") + F.col("duration_s"))
    many = good.groupBy("job_id").count().filter(F.col("count") > ceiling).select("job_id", F.lit(None).cast("string").alias("candidate_id"), F.lit("ceiling").alias("rule"))
    w = Window.partitionBy("job_id").orderBy("anchor", "candidate_id")
    short = good.withColumn("_gap", F.col("anchor") - F.lag("stop").over(w)).filter(F.col("_gap") < recovery - 1e-6).select("job_id", "candidate_id", F.lit("recovery").alias("rule"))
    b = bounds.withColumn("b2", F.col("b"))
    across = overlap(good, b, "job_id", ("anchor", "stop"), ("b", "b2"), 16.0, closed=True).filter("b > anchor and b < stop").select("job_id", "candidate_id", F.lit("straddles").alias("rule")).distinct()
    return decision.unionByName(unknown).unionByName(length).unionByName(many).unionByName(short).unionByName(across)


def verify_package(frames: DataFrame, events: DataFrame, *, fps: float) -> DataFrame:
    """job_id, event, rule for built packages: too few frames for a window (events: job_id, event, a, b), last frame short of its end, A and B counts apart, file-name timecode off, frame outside.

    frames(job_id, event, angle, t, name): names end in the source time as m-ss.mmm.
    """
    code = F.regexp_extract("name", r"_(\d+)-(\d{2}\.\d{3})\.jpg$", 1)
    sec = F.regexp_extract("name", r"_(\d+)-(\d{2}\.\d{3})\.jpg$", 2)
    named = F.when(code != "", code.cast("double") * 60 + sec.cast("double"))
    rows = events.join(frames.withColumn("named", named), ["job_id", "event"], "left")
    g = rows.groupBy("job_id", "event", "a", "b").agg(F.count_if(F.col("angle") == "A").alias("na"), F.count_if(F.col("angle") == "B").alias("nb"), F.max("t").alias("last"), F.bool_or(F.col("t").isNotNull() & F.coalesce(F.abs(F.col("named") - F.col("t")) > 1e-3, F.lit(True))).alias("name_off"), F.bool_or((F.col("t") < F.col("a") - 1e-6) | (F.col("t") > F.col("b") + 1e-6)).alias("outside"))
    need = F.floor((F.col("b") - F.col("a")) * fps) - 1
    rules = F.array(
        F.when(F.greatest("na", "nb") < need, "too_few"),
        F.when(F.coalesce(F.col("last") < F.col("b") - 1 / fps, F.lit(True)), "ends_early"),
        F.when(F.abs(F.col("na") - F.col("nb")) > 1, "uneven"),
        F.when(F.col("name_off"), "timecode"),
        F.when(F.coalesce("outside", F.lit(False)), "outside"),
    )
    return g.select("job_id", "event", F.explode(rules).alias("rule")).filter("rule is not null")
