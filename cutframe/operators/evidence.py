"""Evidence packaging and decision processing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import greedy, overlap
from ..functions.columns import let, record


def event_anchor(cands: DataFrame, contexts: DataFrame) -> DataFrame:
    """anchor and how: context beat, else least start of a SWITCH, else slot start, else the first candidate's start.

    cands(job_id, event, pos, action, timeline_start), contexts(job_id, event, beat, slot)
    """
    switch = F.min(F.when(F.col("action") == "SWITCH", F.col("timeline_start"))).alias("switch")
    g = cands.groupBy("job_id", "event").agg(switch, F.min_by("timeline_start", "pos").alias("first"))
    rows = g.join(contexts, ["job_id", "event"], "left")
    how = F.when(F.col("beat").isNotNull(), "beat").when(F.col("switch").isNotNull(), "switch").when(F.col("slot").isNotNull(), "slot").otherwise("first")
    return rows.select("job_id", "event", F.coalesce("beat", "switch", "slot", "first").alias("anchor"), how.alias("how"))


def select_span(events: DataFrame, lo: float, hi: float, most: int) -> DataFrame:
    """Up to `most` events (job_id, event, anchor) inside the span, with how many lay outside and how many were cut off."""
    inside = (F.col("anchor") >= lo - 1e-6) & (F.col("anchor") <= hi + 1e-6)
    counts = events.groupBy("job_id").agg(F.count_if(~inside).alias("outside"), F.greatest(F.count_if(inside) - most, F.lit(0)).alias("truncated"))
    rank = F.row_number().over(Window.partitionBy("job_id").orderBy("anchor", "event"))
    return events.filter(inside).withColumn("k", rank).filter(F.col("k") <= most).drop("k").join(counts, "job_id")


def strip_aggregates(events: DataFrame, denied: list[str]) -> DataFrame:
    """The map column fields without denied keys, and which were dropped, in order."""
    keys = F.array(*(F.lit(k) for k in denied))
    dropped = F.array_sort(F.array_intersect(F.map_keys("fields"), keys))
    return events.withColumn("dropped", dropped).withColumn("fields", F.map_filter("fields", lambda k, v: ~F.array_contains(keys, k)))


def json_children(path: Column, j: Column) -> Column:
    """(path, key, JSON) of each member of an object and, without a key, of each element of an array."""
    v = F.try_parse_json(j)
    members = F.try_variant_get(v, "$", "map<string,variant>")
    of_object = F.transform(F.json_object_keys(j), lambda k: F.struct(F.concat(path, F.lit("."), k).alias("path"), k.alias("k"), F.to_json(F.element_at(members, k)).alias("j")))
    of_array = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x, i: F.struct(F.concat(path, F.lit("["), i.cast("string"), F.lit("]")).alias("path"), F.lit(None).cast("string").alias("k"), F.to_json(x).alias("j")))
    return F.coalesce(of_object, of_array, F.array().cast("array<struct<path:string,k:string,j:string>>"))


#: The tokens of a JSON text that tell its structure: strings, brackets, colons and commas.
TOKEN = r'"(?:[^"\\]++|\\.)*+"|[\[\]{}:,]'


def key_paths(json: Column, pattern: str) -> Column:
    """Paths of all keys of a JSON text that match, in order, in one fold over its tokens: any depth costs the same plan.

    The state is the open brackets, each with its path and, for an array, the place in it; brackets that don't match make the text no JSON, and null."""
    start = record(
        open=F.array().cast("array<struct<path:string,i:int>>"),
        key=F.lit(None).cast("string"),
        member=F.lit("$"),
        hits=F.array().cast("array<string>"),
        broken=F.lit(False),
    )

    def state(s: Column, **new: Column) -> Column:
        return record(**{f: new.get(f, s[f]) for f in ("open", "key", "member", "hits", "broken")})

    def step(s: Column, x: Column) -> Column:
        top = F.get(s["open"], F.size(s["open"]) - 1)
        rest = F.slice(s["open"], F.lit(1), F.greatest(F.size(s["open"]) - 1, F.lit(0)))
        here = F.when(top["i"] >= 0, F.concat(top["path"], F.lit("["), top["i"].cast("string"), F.lit("]"))).otherwise(s["member"])
        opened = lambda i: state(s, open=F.array_append(s["open"], record(path=here, i=F.lit(i))))
        closed = lambda of_array: state(s, open=rest, broken=s["broken"] | top.isNull() | ((top["i"] >= 0) != of_array))
        plain = F.substring(s["key"], F.lit(2), F.length(s["key"]) - 2)
        key = F.when(s["key"].contains("\\"), F.from_json(F.concat(F.lit("["), s["key"], F.lit("]")), "array<string>")[0]).otherwise(plain)
        named = let(key, lambda k: let(F.concat(top["path"], F.lit("."), k), lambda p: state(s, member=p, hits=F.when(k.rlike(pattern), F.array_append(s["hits"], p)).otherwise(s["hits"]))))
        onward = F.when(top["i"] >= 0, state(s, open=F.array_append(rest, record(path=top["path"], i=top["i"] + 1)))).otherwise(s)
        return (
            F.when(x.startswith('"'), state(s, key=x))
            .when(x == "{", opened(-1))
            .when(x == "[", opened(0))
            .when(x == "}", closed(False))
            .when(x == "]", closed(True))
            .when((x == ":") & top.isNotNull(), named)
            .when((x == ",") & top.isNotNull(), onward)
            .otherwise(state(s, broken=F.lit(True)))
        )

    tokens = F.regexp_extract_all(json, F.lit(TOKEN), F.lit(0))
    return F.aggregate(tokens, start, step, lambda s: F.when(~s["broken"] & (F.size(s["open"]) == 0), s["hits"]))


def aggregate_hits(docs: DataFrame, pattern: str) -> DataFrame:
    """doc_id, path of every key in JSON documents (doc_id, json), in objects and arrays at any level, that looks like a total or a ranking."""
    rows = docs.filter(F.col("json").rlike(r"^\s*[\[{]"))
    return rows.select("doc_id", F.explode(key_paths(F.col("json"), pattern)).alias("path"))


def performance_envelope(cands: DataFrame, lag: float, tolerance: float = 0.036) -> DataFrame:
    """Per event: the union of B faces on the performance clock (source + lag), the timeline's own, and whether they agree."""
    g = cands.groupBy("job_id", "event").agg((F.min("start") + lag).alias("b0"), (F.max("end") + lag).alias("b1"), F.min("timeline_start").alias("a0"), F.max(F.col("timeline_start") + F.col("duration_s")).alias("a1"))
    return g.withColumn("agree", (F.abs(F.col("b0") - F.col("a0")) <= tolerance) & (F.abs(F.col("b1") - F.col("a1")) <= tolerance))


def alignment_failures(cands: DataFrame, envelopes: DataFrame, reels: DataFrame, lag: float, tolerance: float = 0.036) -> DataFrame:
    """job_id, event, rule, n: invariant broken, candidate outside its envelope, envelopes that disagree, candidate past its reel (job_id, length)."""
    c = cands.join(envelopes.select("job_id", "event", "a0", "a1", "agree"), ["job_id", "event"]).join(reels, "job_id", "left")
    rules = F.array(
        F.when(F.abs(F.col("timeline_start") - F.col("start") - lag) > tolerance, "invariant"),
        F.when((F.col("timeline_start") < F.col("a0") - 1e-6) | (F.col("timeline_start") + F.col("duration_s") > F.col("a1") + 1e-6), "outside"),
        F.when(~F.col("agree"), "disagree"),
        F.when(F.coalesce(F.col("end") > F.col("length"), F.lit(True)), "past_reel"),
    )
    return c.select("job_id", "event", F.explode(rules).alias("rule")).filter("rule is not null").groupBy("job_id", "event", "rule").agg(F.count("*").alias("n"))


def dense_schedule(events: DataFrame, lo: float, hi: float, window: float = 4.0, fps: float = 2.0) -> DataFrame:
    """Frames of each event (job_id, event, anchor): round(length * fps) + 1 evenly spaced instants of its window, clamped to the span."""
    e = events.withColumns({"a": F.greatest(F.col("anchor") - window / 2, F.lit(lo)), "b": F.least(F.col("anchor") + window / 2, F.lit(hi))}).filter("b >= a")
    n = F.greatest(F.lit(1), F.bround((F.col("b") - F.col("a")) * fps, 0).cast("int") + 1)
    e = e.withColumn("n", n).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return e.select("job_id", "event", "i", "n", (F.col("a") + F.col("i") * (F.col("b") - F.col("a")) / F.greatest(F.lit(1), F.col("n") - 1)).alias("t"))


def sheet_schedule(spans: DataFrame, every: float = 10.0, per: int = 30) -> DataFrame:
    """Contact sheets of each span (job_id, a, b): one frame each `every` seconds, `per` to a sheet: frames, padding, bounds."""
    n = F.ceil((F.col("b") - F.col("a") - 1e-9) / every).cast("int")
    rows = spans.withColumn("n", n).filter("n > 0").withColumn("sheet", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / per).cast("int"))))
    k = F.least(F.lit(per), F.col("n") - F.col("sheet") * per)
    return rows.select("job_id", "sheet", k.alias("frames"), (per - k).alias("padding"), (F.col("a") + F.col("sheet") * per * every).alias("from_s"), (F.col("a") + (F.col("sheet") * per + k - 1) * every).alias("to_s"))


def segment_facts(spans: DataFrame, beats: DataFrame, action: DataFrame) -> DataFrame:
    """Per span (job_id, pos, a, b): beats and downbeats (each fourth) inside, and mean, nearest-rank p90 and peak of action samples (job_id, t, v)."""
    b = overlap(spans, beats.withColumn("t2", F.col("t")), "job_id", ("a", "b"), ("t", "t2"), 16.0, closed=True).groupBy("job_id", "pos").agg(F.count("*").alias("beats"), F.count_if(F.col("i") % 4 == 0).alias("downbeats"))
    s = overlap(spans, action.withColumn("t2", F.col("t")), "job_id", ("a", "b"), ("t", "t2"), 16.0, closed=True)
    rank = F.element_at(F.array_sort(F.collect_list("v")), F.bround((F.count("*") - 1) * F.lit(0.9), 0).cast("int") + 1)
    g = s.groupBy("job_id", "pos").agg(F.avg("v").alias("mean"), rank.alias("p90"), F.max("v").alias("peak"))
    return spans.select("job_id", "pos").join(b, ["job_id", "pos"], "left").join(g, ["job_id", "pos"], "left").fillna(0, ["beats", "downbeats"])


def cost_rollup(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Tokens and cost by role, and over all: usage(role, tokens), prices(role, per_million)."""
    g = usage.groupBy("role").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"))
    rows = g.join(prices, "role", "left").select("role", "n", "tokens", (F.col("tokens") * F.coalesce("per_million", F.lit(0.0)) / 1e6).alias("cost"))
    total = rows.agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens"), F.sum("cost").alias("cost")).select(F.lit("all").alias("role"), "n", "tokens", "cost")
    return rows.unionByName(total)


def validate_decisions(decisions: DataFrame, cands: DataFrame, *, longest: int = 240) -> DataFrame:
    """job_id, event, rule: events without a decision, decisions on unknown events, repeated ones, selections that aren't offered, confidence outside 0..1, long rationales."""
    events = cands.select("job_id", "event").distinct()
    missing = events.join(decisions, ["job_id", "event"], "left_anti").withColumn("rule", F.lit("missing"))
    unknown = decisions.join(events, ["job_id", "event"], "left_anti").select("job_id", "event").distinct().withColumn("rule", F.lit("unknown_event"))
    again = decisions.groupBy("job_id", "event").count().filter("count > 1").select("job_id", "event", F.lit("duplicate").alias("rule"))
    known = decisions.join(events, ["job_id", "event"], "left_semi").filter("selection <> 'HOLD_A'")
    illegal = known.join(cands.select("job_id", "event", F.col("candidate_id").alias("selection")), ["job_id", "event", "selection"], "left_anti").select("job_id", "event", F.lit("illegal_selection").alias("rule"))
    own = decisions.select("job_id", "event", F.explode(F.array(F.when(~F.col("confidence").between(0, 1) | F.col("confidence").isNull(), "confidence"), F.when(F.length("rationale") > longest, "rationale"))).alias("rule")).filter("rule is not null")
    return missing.unionByName(unknown).unionByName(again).unionByName(illegal).unionByName(own)


def resolve_citations(texts: DataFrame, intervals: DataFrame, slack: float = 0.5) -> DataFrame:
    """Timecodes m:ss.d in texts (job_id, event, text): the earliest evidence interval (job_id, ev_id, a, b) that holds each, or UNRESOLVED."""
    codes = texts.select("job_id", "event", F.posexplode(F.regexp_extract_all("text", F.lit(r"\b(\d+:\d{2}(?:\.\d+)?)\b"), F.lit(1))).alias("i", "code"))
    codes = codes.withColumn("t", F.split("code", ":")[0].cast("double") * 60 + F.split("code", ":")[1].cast("double")).withColumn("t2", F.col("t"))
    hit = overlap(codes, intervals, "job_id", ("t", "t2"), ("a", "b"), 64.0, closed=True, slack=slack).groupBy("job_id", "event", "i").agg(F.min_by("ev_id", F.struct("a", "ev_id")).alias("ev"))
    return codes.drop("t2").join(hit, ["job_id", "event", "i"], "left").select("job_id", "event", "i", "code", "t", F.coalesce(F.col("ev").cast("string"), F.lit("UNRESOLVED")).alias("evidence"))


def materialize_chain(decisions: DataFrame, lo: float, recovery: float) -> DataFrame:
    """Chosen inserts (job_id, event, a, b) in time order, each at least `recovery` after the exit of the last kept one; the first counts from lo."""
    ok = lambda kept, x: x["a"] - F.when(F.size(kept) == 0, F.lit(lo)).otherwise(F.element_at(kept, -1)["b"]) >= recovery
    kept = greedy(decisions, ["job_id"], [("a", False), ("event", False)], ["event", "a", "b"], ok)
    forced = decisions.join(kept.select("job_id", "event"), ["job_id", "event"], "left_anti")
    return kept.withColumn("state", F.lit("kept")).unionByName(forced.select("job_id", "event", "a", "b", F.lit("forced_hold").alias("state")))


def compare_decisions(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two decision sets (job_id, event, selection, confidence) side by side, per job: changed, confidence up and down, holds."""
    both = a.alias("a").join(b.alias("b"), ["job_id", "event"])
    hold = lambda x: F.count_if(F.col(f"{x}.selection") == "HOLD_A")
    return both.groupBy("job_id").agg(F.count("*").alias("n"), F.count_if(F.col("a.selection") != F.col("b.selection")).alias("changed"), F.count_if(F.col("b.confidence") > F.col("a.confidence")).alias("up"), F.count_if(F.col("b.confidence") < F.col("a.confidence")).alias("down"), hold("a").alias("holds_a"), hold("b").alias("holds_b"))


def topic_rates(texts: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Per group, the share of texts (grp, text) that match each topic pattern."""
    return texts.groupBy("grp").agg(F.count("*").alias("n"), *((F.count_if(F.col("text").rlike(p)) / F.count("*")).alias(n) for n, p in patterns.items()))


def decision_distribution(chain: DataFrame, ceiling: float) -> DataFrame:
    """Per side (chain: side, duration_s, confidence): counts, least, median, mean, greatest duration, how many reach the ceiling, mean confidence."""
    d = F.col("duration_s")
    return chain.groupBy("side").agg(F.count("*").alias("n"), F.min(d).alias("least"), F.percentile(d, 0.5).alias("median"), F.avg(d).alias("mean"), F.max(d).alias("most"), F.count_if(d >= ceiling).alias("at_ceiling"), F.avg("confidence").alias("confidence"))


def ground_claims(frames: DataFrame, claims: DataFrame, margin: float = 2.0) -> DataFrame:
    """Mean luma of each event's A and B frames (job_id, event, angle, k, luma), every n//5-th, and a verdict for rationales (job_id, event, text) that speak of darkness."""
    w = Window.partitionBy("job_id", "event", "angle")
    rows = frames.withColumns({"_i": F.row_number().over(w.orderBy("k")) - 1, "_n": F.count("*").over(w)})
    picked = rows.filter(F.pmod(F.col("_i"), F.greatest(F.lit(1), F.floor(F.col("_n") / 5))) == 0)
    g = picked.groupBy("job_id", "event").agg(F.avg(F.when(F.col("angle") == "A", F.col("luma"))).alias("a"), F.avg(F.when(F.col("angle") == "B", F.col("luma"))).alias("b"))
    dark = claims.filter(F.col("text").rlike("(?i)dark|dim|black")).select("job_id", "event")
    verdict = F.when(F.col("a").isNull() | F.col("b").isNull(), "unmeasured").when(F.col("b") < F.col("a") - margin, "darker").when(F.col("b") > F.col("a") + margin, "brighter").otherwise("equal")
    return g.join(dark, ["job_id", "event"]).select("job_id", "event", "a", "b", verdict.alias("verdict"))


def legality(cands: DataFrame, *, least: float, most: float, lag: float, tolerance: float = 0.036) -> DataFrame:
    """Per event, which rules hold for all its candidates: lengths in bounds, end after start, sync invariant, unique ids, ascending lengths with ids."""
    w = Window.partitionBy("job_id", "event").orderBy("candidate_id")
    rows = cands.withColumn("_prev", F.lag("duration_s").over(w))
    ok = lambda c: F.bool_and(F.coalesce(c, F.lit(True)))
    return rows.groupBy("job_id", "event").agg(F.count("*").alias("n"), ok(F.col("duration_s").between(least, most)).alias("length_ok"), ok(F.col("end") > F.col("start")).alias("order_ok"), ok(F.abs(F.col("timeline_start") - F.col("start") - lag) <= tolerance).alias("sync_ok"), (F.count_distinct("candidate_id") == F.count("*")).alias("ids_ok"), ok(F.col("duration_s") >= F.col("_prev")).alias("ladder_ok"))


def artifact_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per job: candidates in both, only old, only new, and mean, p90 and greatest entry displacement (job_id, candidate_id, start)."""
    both = old.select("job_id", "candidate_id", F.col("start").alias("o")).join(new.select("job_id", "candidate_id", F.col("start").alias("n")), ["job_id", "candidate_id"], "full")
    d = F.abs(F.col("n") - F.col("o"))
    return both.groupBy("job_id").agg(F.count(d).alias("both"), F.count_if(F.col("n").isNull()).alias("only_old"), F.count_if(F.col("o").isNull()).alias("only_new"), F.avg(d).alias("mean"), F.percentile(d, 0.9).alias("p90"), F.max(d).alias("most"))


def parse_decisions(texts: DataFrame) -> DataFrame:
    """doc_id, form, i, event_id, selection from raw answers (doc_id, text): code fences stripped, the outermost JSON, a list or one wrapped under a known name."""
    bare = F.regexp_replace("text", r"```[a-z]*", "")
    span = F.coalesce(F.nullif(F.regexp_extract(bare, r"(?s)(\[\s*\{.*\}\s*\])", 1), F.lit("")), F.nullif(F.regexp_extract(bare, r"(?s)(\{.*\})", 1), F.lit("")))
    v = texts.select("doc_id", F.try_parse_json(F.coalesce(F.when(bare.rlike(r"^\s*\{"), F.regexp_extract(bare, r"(?s)(\{.*\})", 1)), span)).alias("v"))
    names = ("decisions", "chain", "events", "results", "result")
    listed = [F.try_variant_get("v", f"$.{n}", "array<variant>") for n in names]
    own = F.try_variant_get("v", "$", "array<variant>")
    form = F.coalesce(F.when(own.isNotNull(), "list"), *(F.when(x.isNotNull(), n) for n, x in zip(names, listed, strict=True)))
    rows = v.select("doc_id", form.alias("form"), F.posexplode(F.coalesce(own, *listed)).alias("i", "x"))
    return rows.select("doc_id", "form", "i", F.try_variant_get("x", "$.event_id", "string").alias("event_id"), F.try_variant_get("x", "$.selection", "string").alias("selection"))
