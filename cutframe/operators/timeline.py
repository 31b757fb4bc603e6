"""Timeline and programme algebra over cuts (job_id, pos, cut_id, angle, source_in, source_out)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import apart, around, greedy, islands, overlap

JOB = ["job_id"]


def in_order(*more: str) -> Window:
    return Window.partitionBy("job_id").orderBy("pos", *more)


def program_times(cuts: DataFrame) -> DataFrame:
    """proof_in and proof_out: the programme time of each cut, the running sum of durations before and after it."""
    w = in_order().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    length = F.col("source_out") - F.col("source_in")
    out = F.sum(length).over(w)
    return cuts.withColumns({"proof_in": out - length, "proof_out": out})


def virtual_reel(cards: DataFrame) -> DataFrame:
    """reel, idx, name, start, end: ordered files laid end to end."""
    w = Window.partitionBy("reel").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cards.select("reel", "idx", "name", (F.sum("duration_s").over(w) - F.col("duration_s")).alias("start"), F.sum("duration_s").over(w).alias("end"))


def resolve_segments(cuts: DataFrame, reel: DataFrame) -> DataFrame:
    """Cuts of the given angle split at every file boundary of their job's reel: file name and times inside the file."""
    r = reel.select(F.col("reel").alias("job_id"), "idx", "name", F.col("start").alias("v0"), F.col("end").alias("v1"))
    parts = overlap(cuts, r, "job_id", ("source_in", "source_out"), ("v0", "v1"), 64.0)
    a, b = F.greatest("source_in", "v0"), F.least("source_out", "v1")
    return parts.select("job_id", "pos", "idx", "name", (a - F.col("v0")).alias("file_in"), (b - F.col("v0")).alias("file_out"))


def unplaced(cuts: DataFrame, segments: DataFrame) -> DataFrame:
    return cuts.join(segments, ["job_id", "pos"], "left_anti")


def frame_counts(segs: DataFrame, num: int = 30000, den: int = 1001) -> DataFrame:
    """Frames of each segment from global boundaries: round(end fps) - round(start fps), half to even."""
    fps = num / den
    edge = lambda c: F.bround(F.col(c) * fps, 0).cast("bigint")
    return segs.withColumn("frames", edge("proof_out") - edge("proof_in"))


def chunk_segments(segs: DataFrame, fps: int = 25, max_s: float = 10.0) -> DataFrame:
    """Frame-aligned chunks of at most max_s: first frame, frames, and the midpoint in seconds."""
    k = int(max_s * fps)
    f0, f1 = F.bround(F.col("proof_in") * fps, 0).cast("bigint"), F.bround(F.col("proof_out") * fps, 0).cast("bigint")
    rows = segs.withColumns({"f0": f0, "f1": f1}).filter("f1 > f0")
    rows = rows.withColumn("frame", F.explode(F.expr(f"sequence(f0, f1 - 1, {k}L)")))
    n = F.least(F.lit(k).cast("bigint"), F.col("f1") - F.col("frame"))
    return rows.select("job_id", "pos", "frame", n.alias("frames"), ((F.col("frame") + n / 2.0) / fps).alias("mid_s"))


def truncate(segs: DataFrame, target: float) -> DataFrame:
    """Segments up to the target programme time; the one across it is trimmed."""
    return segs.filter(F.col("proof_in") < target).withColumn("source_out", F.col("source_in") + F.least(F.col("proof_out"), F.lit(target)) - F.col("proof_in")).withColumn("proof_out", F.least(F.col("proof_out"), F.lit(target)))


def density_sections(spine: DataFrame, overrides: DataFrame, least: float = 0.5) -> DataFrame:
    """A spine minus overrides plus the overrides, in order; each clamped to the cursor; what is 0.5 s or less goes.

    spine(job_id, start, end), overrides(job_id, start, end, density)
    """
    w = Window.partitionBy("job_id").orderBy("start", "end")
    before = F.coalesce(F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(float("-inf")))
    o = overrides.withColumn("_before", before).withColumn("start", F.greatest("start", "_before")).filter(F.col("end") > F.col("start")).drop("_before")
    edges = o.join(spine.select("job_id", F.col("start").alias("s0"), F.col("end").alias("s1")), "job_id")
    edges = edges.withColumns({"start": F.greatest("start", "s0"), "end": F.least("end", "s1")}).filter("end > start")
    gap_from = F.coalesce(F.lag("end").over(w), F.col("s0"))
    gaps = edges.select("job_id", gap_from.alias("start"), F.col("start").alias("end"), F.lit(None).cast("double").alias("density"))
    tail = edges.groupBy("job_id").agg(F.max("end").alias("start"), F.first("s1").alias("end")).withColumn("density", F.lit(None).cast("double"))
    plain = spine.join(edges, "job_id", "left_anti").select("job_id", "start", "end", F.lit(None).cast("double").alias("density"))
    return gaps.unionByName(tail).unionByName(plain).unionByName(edges.select("job_id", "start", "end", "density")).filter(F.col("end") - F.col("start") > least)


def timeline_stats(cuts: DataFrame) -> DataFrame:
    """Per job: cuts, B cuts, B share in percent, B shot min/max/mean, least recovery between B shots, runtime."""
    timed = program_times(cuts)
    b = F.col("angle") == "B"
    last_b = F.max(F.when(b, F.col("proof_out"))).over(in_order().rowsBetween(Window.unboundedPreceding, -1))
    d = F.col("source_out") - F.col("source_in")
    rows = timed.withColumns({"d": d, "gap": F.when(b, F.col("proof_in") - last_b)})
    return rows.groupBy("job_id").agg(
        F.count("*").alias("cuts"),
        F.count_if(b).alias("b_cuts"),
        (100 * F.coalesce(F.sum(F.when(b, F.col("d"))), F.lit(0.0)) / F.sum("d")).alias("b_pct"),
        F.min(F.when(b, F.col("d"))).alias("b_min"),
        F.max(F.when(b, F.col("d"))).alias("b_max"),
        F.avg(F.when(b, F.col("d"))).alias("b_avg"),
        F.min(F.when(F.col("gap") > 1e-6, F.col("gap"))).alias("min_recovery"),
        F.sum("d").alias("runtime"),
    )


def policy_violations(cuts: DataFrame, policy: DataFrame) -> DataFrame:
    """job_id, pos (null for a whole job), rule. policy(job_id, density 'lo-hi' in percent, min_b, max_b, min_recovery)."""
    p = policy.select("job_id", F.regexp_extract("density", r"^\s*([0-9.]+)", 1).cast("double").alias("lo"), F.regexp_extract("density", r"([0-9.]+)\s*%?\s*$", 1).cast("double").alias("hi"), "min_b", "max_b", "min_recovery")
    stats = timeline_stats(cuts).join(p, "job_id")
    whole = stats.select("job_id", F.lit(None).cast("bigint").alias("pos"), F.when(F.col("b_pct") < F.col("lo"), "density_low").when(F.col("b_pct") > F.col("hi"), "density_high").alias("rule"))
    w = in_order()
    d = F.col("source_out") - F.col("source_in")
    rows = cuts.withColumns({"d": d, "after_b": F.lag("angle").over(w) == "B", "more": F.lead("angle").over(w).isNotNull()}).join(p, "job_id")
    b = F.col("angle") == "B"
    rules = F.array(
        F.when(b & (d < F.col("min_b")), "shot_short"),
        F.when(b & (d > F.col("max_b")), "shot_long"),
        F.when(b & (F.col("confidence") == "low"), "low_confidence"),
        F.when(~b & F.col("after_b") & F.col("more") & (d < F.col("min_recovery")), "short_recovery"),
    )
    each = rows.select("job_id", "pos", F.explode(rules).alias("rule"))
    return whole.unionByName(each).filter("rule is not null")


def angle_runs(cuts: DataFrame, angle: str = "A", threshold: float = 20.0) -> DataFrame:
    """Uninterrupted runs of an angle in programme time: bounds, cut ids in order, whether over the threshold."""
    timed = program_times(cuts)
    runs = islands(timed, JOB, ["pos"], F.lag("angle").over(in_order()) != F.col("angle"), "run").filter(F.col("angle") == angle)
    g = runs.groupBy("job_id", "run").agg(F.min("proof_in").alias("start"), F.max("proof_out").alias("end"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "cut_id"))), lambda x: x["cut_id"]).alias("ids"))
    return g.withColumns({"long": F.col("end") - F.col("start") > threshold})


def offer_opportunities(runs: DataFrame, faces: DataFrame, edge: float = 10.0, separation: float = 20.0, top: int = 4) -> DataFrame:
    """For long runs, up to `top` events inside with clear edges, longest face first, each apart from the one picked before.

    faces(job_id, event_id, at, face_s): the longest legal face of each event and its programme time.
    """
    r = runs.filter("long").select("job_id", "run", (F.col("start") + edge).alias("a"), (F.col("end") - edge).alias("b")).filter("b >= a")
    inside = overlap(faces.withColumn("at2", F.col("at")), r, "job_id", ("at", "at2"), ("a", "b"), 64.0, closed=True)
    return greedy(inside, ["job_id", "run"], [("face_s", True), ("at", False), ("event_id", False)], ["event_id", "at", "face_s"], lambda kept, x: (F.size(kept) == 0) | (F.abs(F.element_at(kept, -1)["at"] - x["at"]) >= separation), top)


def apply_promotions(segs: DataFrame, promos: DataFrame) -> DataFrame:
    """Split A segments (proof times) around B inserts. promos(job_id, promo, p_in, p_out, b_in): inserts of a job don't overlap.

    Pieces and inserts come back in programme order, renumbered, with their origin. A piece after an insert starts where that insert ended.
    """
    s = segs.select("job_id", "pos", "angle", "proof_in", "proof_out", "source_in")
    hit = overlap(s.filter("angle = 'A'"), promos, "job_id", ("proof_in", "proof_out"), ("p_in", "p_out"), 64.0)
    hit = hit.filter("p_in >= proof_in and p_out <= proof_out")
    w = Window.partitionBy("job_id", "pos").orderBy("p_in")
    cut = hit.withColumns({"from_": F.coalesce(F.lag("p_out").over(w), F.col("proof_in")), "last": F.lead("p_in").over(w).isNull()})
    shift = F.col("source_in") - F.col("proof_in")
    before = cut.select("job_id", F.col("from_").alias("proof_in"), F.col("p_in").alias("proof_out"), F.lit("A").alias("angle"), (F.col("from_") + shift).alias("source_in"), F.lit("split").alias("origin"))
    after = cut.filter("last").select("job_id", F.col("p_out").alias("proof_in"), "proof_out", F.lit("A").alias("angle"), (F.col("p_out") + shift).alias("source_in"), F.lit("split").alias("origin"))
    insert = cut.select("job_id", F.col("p_in").alias("proof_in"), F.col("p_out").alias("proof_out"), F.lit("B").alias("angle"), F.col("b_in").alias("source_in"), F.lit("promotion").alias("origin"))
    rest = s.join(hit, ["job_id", "pos"], "left_anti").select("job_id", "proof_in", "proof_out", "angle", "source_in", F.lit("kept").alias("origin"))
    every = before.unionByName(after).unionByName(insert).unionByName(rest).filter("proof_out > proof_in")
    return every.withColumn("pos", F.row_number().over(Window.partitionBy("job_id").orderBy("proof_in")) - 1)


def program_rollup(cuts: DataFrame) -> DataFrame:
    """Total seconds, longest uninterrupted A run, B seconds and B percent per job."""
    runs = angle_runs(cuts).groupBy("job_id").agg(F.max(F.col("end") - F.col("start")).alias("longest_a"))
    d = F.col("source_out") - F.col("source_in")
    total = cuts.groupBy("job_id").agg(F.sum(d).alias("total_s"), F.coalesce(F.sum(F.when(F.col("angle") == "B", d)), F.lit(0.0)).alias("b_s"))
    return total.join(runs, "job_id", "left").select("job_id", "total_s", F.coalesce("longest_a", F.lit(0.0)).alias("longest_a"), "b_s", (100 * F.col("b_s") / F.col("total_s")).alias("b_pct"))


def boundary_ownership(bounds: DataFrame, segs: DataFrame, slack: float = 0.02) -> DataFrame:
    """For each boundary (job_id, bound_id, t): the segment that holds it, those before and after, and whether it is a cut."""
    s = segs.select("job_id", F.col("proof_in").alias("s_in"), F.col("proof_out").alias("s_out"), "cut_id")
    ended = around(bounds, s.select("job_id", "s_out", F.col("cut_id").alias("c")), "job_id", "t", "s_out", ["c"]).select(*bounds.columns, F.col("prev_c").alias("before"), F.col("prev_s_out").alias("left_edge"))
    begun = around(ended, s.select("job_id", "s_in", F.col("cut_id").alias("c"), "s_out"), "job_id", "t", "s_in", ["c", "s_out"])
    inside = F.col("prev_s_in").isNotNull() & (F.col("t") < F.col("prev_s_out"))
    near = F.least(F.abs(F.col("t") - F.col("left_edge")), F.abs(F.col("t") - F.col("prev_s_in")), F.abs(F.col("next_s_in") - F.col("t")))
    return begun.select(*bounds.columns, F.when(inside, F.col("prev_c")).alias("containing"), "before", F.col("next_c").alias("after"), F.coalesce(near <= slack, F.lit(False)).alias("is_cut"))


def headers_agree(artifacts: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Whether all artifacts of a group have one header: the number of different fingerprints is 1."""
    print_ = F.sha2(F.concat_ws("|", *(F.coalesce(F.col(f).cast("string"), F.lit("~")) for f in fields)), 256)
    return artifacts.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct(print_).alias("headers")).withColumn("agree", F.col("headers") == 1)


def chain_to_timeline(inserts: DataFrame, spans: DataFrame) -> DataFrame:
    """B inserts (job_id, tl_in, tl_out) with A filling the gaps of the job's span (job_id, lo, hi)."""
    w = Window.partitionBy("job_id").orderBy("tl_in")
    x = inserts.join(spans, "job_id").withColumns({"prev": F.coalesce(F.lag("tl_out").over(w), F.col("lo")), "tail": F.lead("tl_in").over(w).isNull()})
    gap = x.select("job_id", F.col("prev").alias("a"), F.col("tl_in").alias("b"), F.lit("A").alias("angle"))
    last = x.filter("tail").select("job_id", F.col("tl_out").alias("a"), F.col("hi").alias("b"), F.lit("A").alias("angle"))
    b = x.select("job_id", F.col("tl_in").alias("a"), F.col("tl_out").alias("b"), F.lit("B").alias("angle"))
    every = gap.unionByName(last).unionByName(b).filter("b > a")
    return every.withColumn("pos", F.row_number().over(Window.partitionBy("job_id").orderBy("a")) - 1)


def context_proof(picks: DataFrame, context: float) -> DataFrame:
    """Chosen inserts, each after `context` seconds of A: proof times. picks(job_id, pos, source_in, source_out)."""
    part = F.explode(F.array(F.struct(F.lit(0).alias("part"), F.lit("A").alias("angle"), (F.col("source_in") - context).alias("a"), F.col("source_in").alias("b")), F.struct(F.lit(1).alias("part"), F.lit("B").alias("angle"), F.col("source_in").alias("a"), F.col("source_out").alias("b"))))
    rows = picks.select("job_id", "pos", part.alias("p")).select("job_id", "pos", "p.*").withColumnsRenamed({"a": "source_in", "b": "source_out"})
    w = Window.partitionBy("job_id").orderBy("pos", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = F.col("source_out") - F.col("source_in")
    return rows.withColumns({"proof_out": F.sum(d).over(w)}).withColumn("proof_in", F.col("proof_out") - d)


def match_cuts(proposed: DataFrame, approved: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Each proposed B cut, in order, with the nearest approved start within tolerance that is not used yet (job_id, p_pos, a_pos). Pairs are folded by parts of a job that no tolerance joins."""
    a = approved.select("job_id", F.col("pos").alias("a_pos"), F.col("source_in").alias("a_in")).withColumn("a_end", F.col("a_in"))
    p = proposed.select("job_id", F.col("pos").alias("p_pos"), (F.col("source_in") - tolerance).alias("lo"), (F.col("source_in") + tolerance).alias("hi"), F.col("source_in").alias("p_in"))
    pairs = overlap(p, a, "job_id", ("lo", "hi"), ("a_in", "a_end"), 16.0, closed=True).withColumn("dist", F.abs(F.col("a_in") - F.col("p_in")))
    pairs = apart(pairs, JOB, F.col("p_in") - tolerance, F.col("p_in") + tolerance, ["p_pos", "a_pos"], closed=True)
    return greedy(pairs, [*JOB, "_part"], [("p_pos", False), ("dist", False), ("a_pos", False)], ["p_pos", "a_pos", "dist"], lambda kept, x: ~F.exists(kept, lambda k: (k["p_pos"] == x["p_pos"]) | (k["a_pos"] == x["a_pos"]))).drop("_part")


def classify_deltas(proposed: DataFrame, approved: DataFrame, pairs: DataFrame, enter: float = 0.25, hold: float = 0.25) -> DataFrame:
    """job_id, p_pos, a_pos, delta: angle_flipped, entered_late/early, held_longer/shortened or unchanged; removed_/added_ with the angle."""
    p = proposed.select("job_id", F.col("pos").alias("p_pos"), F.col("angle").alias("p_angle"), F.col("source_in").alias("p_in"), (F.col("source_out") - F.col("source_in")).alias("p_d"))
    a = approved.select("job_id", F.col("pos").alias("a_pos"), F.col("angle").alias("a_angle"), F.col("source_in").alias("a_in"), (F.col("source_out") - F.col("source_in")).alias("a_d"))
    both = pairs.select("job_id", "p_pos", "a_pos").join(p, ["job_id", "p_pos"]).join(a, ["job_id", "a_pos"])
    late, longer = F.col("a_in") - F.col("p_in"), F.col("a_d") - F.col("p_d")
    tags = F.filter(
        F.array(
            F.when(F.col("a_angle") != F.col("p_angle"), "angle_flipped"),
            F.when(late > enter, "entered_late").when(late < -enter, "entered_early"),
            F.when(longer > hold, "held_longer").when(longer < -hold, "shortened"),
        ),
        lambda x: x.isNotNull(),
    )
    changed = both.select("job_id", "p_pos", "a_pos", F.explode(F.when(F.size(tags) == 0, F.array(F.lit("unchanged"))).otherwise(tags)).alias("delta"))
    gone = p.join(pairs, ["job_id", "p_pos"], "left_anti").select("job_id", "p_pos", F.lit(None).cast("bigint").alias("a_pos"), F.concat(F.lit("removed_"), "p_angle").alias("delta"))
    new = a.join(pairs, ["job_id", "a_pos"], "left_anti").select("job_id", F.lit(None).cast("bigint").alias("p_pos"), "a_pos", F.concat(F.lit("added_"), "a_angle").alias("delta"))
    return changed.unionByName(gone).unionByName(new)


def disagreement_profile(deltas: DataFrame) -> DataFrame:
    """Per delta: rows, jobs, and rows per job that has any delta, most frequent first by rank."""
    jobs = deltas.agg(F.count_distinct("job_id").alias("all_jobs"))
    g = deltas.groupBy("delta").agg(F.count("*").alias("n"), F.count_distinct("job_id").alias("jobs")).crossJoin(F.broadcast(jobs))
    return g.select("delta", "n", "jobs", (F.col("n") / F.col("all_jobs")).alias("per_job"))


def edl_ticks(ranges: DataFrame, fps: Column | float = 25.0) -> DataFrame:
    """Ranges (job_id, pos, name, a, b, fps_num, fps_den) as source frames and running sequence ticks of 1/fps; empty ones go.

    format_id numbers the job's different rates in order.
    """
    rate = F.col("fps_num") / F.col("fps_den")
    f0, f1 = F.bround(F.col("a") * rate, 0).cast("bigint"), F.bround(F.col("b") * rate, 0).cast("bigint")
    rows = ranges.withColumns({"src": f0, "frames": f1 - f0}).filter("frames > 0")
    w = in_order().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ticks = F.bround((F.col("frames") * F.col("fps_den") / F.col("fps_num")) * 120000, 0).cast("bigint")
    fmt = F.dense_rank().over(Window.partitionBy("job_id").orderBy("fps_num", "fps_den"))
    return rows.withColumn("ticks", ticks).select("job_id", "pos", "src", "frames", "ticks", (F.sum("ticks").over(w) - F.col("ticks")).alias("at"), fmt.cast("bigint").alias("format_id"))
