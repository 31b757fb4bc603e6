"""Manifest validation as data-quality jobs over many manifests: one row per violation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.blocks import overlap
from .evidence import json_children

#: The manifest's structure, by place: [*] is an element, .* any member (fixed values).
NAME = {"kinds": ["string"], "least_length": 1}
NUMBER = {"kinds": ["number"]}
FLAG = {"kinds": ["boolean"]}
MANIFEST_RULES: dict[str, dict] = {
    "$": {"kinds": ["object"], "required": ["manifest_version", "job_id", "template", "sources", "timeline", "profiles"], "fields": ["manifest_version", "job_id", "template", "sources", "timeline", "profiles", "postflight", "pre_grades"], "closed": True},
    "$.manifest_version": {"kinds": ["number"], "among": ["1"]},
    "$.job_id": {"kinds": ["string"], "least_length": 1, "most_length": 64, "pattern": "^[A-Za-z0-9][A-Za-z0-9_.-]*$"},
    "$.template": NAME,
    "$.sources": {"kinds": ["object"], "required": ["a_reel"], "fields": ["a_reel", "b_reel"], "closed": True},
    "$.sources.a_reel": NAME,
    "$.sources.b_reel": {"kinds": ["array"]},
    "$.sources.b_reel[*]": NAME,
    "$.timeline": {"kinds": ["array"], "least_items": 1},
    "$.timeline[*]": {"kinds": ["object"], "required": ["id", "angle", "source_in", "source_out"], "fields": ["id", "angle", "source_in", "source_out", "confidence"], "closed": True},
    "$.timeline[*].id": {"kinds": ["string"], "pattern": r"^cut_\d{3}$"},
    "$.timeline[*].angle": {"kinds": ["string"], "among": ["A", "B"]},
    "$.timeline[*].source_in": {"kinds": ["number"], "least": 0.0},
    "$.timeline[*].source_out": {"kinds": ["number"], "least": 0.0},
    "$.timeline[*].confidence": {"kinds": ["string"], "among": ["low", "high"]},
    "$.profiles": {"kinds": ["object"], "required": ["grade", "crop", "graphics", "audio"], "fields": ["grade", "crop", "graphics", "audio"], "closed": True},
    "$.profiles.grade": NAME,
    "$.profiles.crop": NAME,
    "$.profiles.graphics": NAME,
    "$.profiles.audio": NAME,
    "$.postflight": {"kinds": ["object"], "required": ["status"], "fields": ["status", "checked_at", "integrated_lufs", "true_peak_dbtp", "lra", "duration_s", "bt709", "delivered_file", "pre_grades_applied"], "closed": True},
    "$.postflight.status": {"kinds": ["string"], "among": ["passed", "failed"]},
    "$.postflight.checked_at": {"kinds": ["string"]},
    "$.postflight.integrated_lufs": NUMBER,
    "$.postflight.true_peak_dbtp": NUMBER,
    "$.postflight.lra": NUMBER,
    "$.postflight.duration_s": {"kinds": ["number"], "least": 0.0},
    "$.postflight.bt709": {"kinds": ["object"], "fields": ["primaries", "transfer", "matrix"], "closed": True},
    "$.postflight.bt709.primaries": FLAG,
    "$.postflight.bt709.transfer": FLAG,
    "$.postflight.bt709.matrix": FLAG,
    "$.postflight.delivered_file": NAME,
    "$.postflight.pre_grades_applied": {"kinds": ["object"]},
    "$.postflight.pre_grades_applied.*": {"kinds": ["object"]},
    "$.postflight.pre_grades_applied.*.*": {"kinds": ["string", "number", "boolean"]},
    "$.pre_grades": {"kinds": ["object"]},
    "$.pre_grades.*": {"kinds": ["string", "object"], "least_length": 1, "required": ["mode", "points"], "fields": ["mode", "interpolation", "units", "max_chunk_s", "points"]},
    "$.pre_grades.*.mode": {"kinds": ["string"], "among": ["time_varying"]},
    "$.pre_grades.*.interpolation": {"kinds": ["string"], "among": ["linear"]},
    "$.pre_grades.*.units": {"kinds": ["string"], "among": ["source_seconds"]},
    "$.pre_grades.*.max_chunk_s": {"kinds": ["number"], "least": 1.0, "most": 600.0},
    "$.pre_grades.*.points": {"kinds": ["array"], "least_items": 1},
    "$.pre_grades.*.points[*]": {"kinds": ["object"], "required": ["t", "curve"], "fields": ["t", "curve", "gamma", "sat"]},
    "$.pre_grades.*.points[*].t": NUMBER,
    "$.pre_grades.*.points[*].curve": NAME,
    "$.pre_grades.*.points[*].gamma": NUMBER,
    "$.pre_grades.*.points[*].sat": NUMBER,
}


def validate_registry(manifests: DataFrame, registry: DataFrame) -> DataFrame:
    """job_id, category, name, known: profile names (job_id, category, name) that the registry (category, name) lacks, with its known list."""
    known = registry.groupBy("category").agg(F.array_join(F.array_sort(F.collect_set("name")), ",").alias("known"))
    return manifests.join(registry, ["category", "name"], "left_anti").join(known, "category", "left").select("job_id", "category", "name", F.coalesce("known", F.lit("")).alias("known"))


def validate_timeline(cuts: DataFrame, reels: DataFrame) -> DataFrame:
    """job_id, pos, rule: repeated cut ids, out not after in, per-angle order and overlap, B without a reel (reels: job_id)."""
    by_angle = Window.partitionBy("job_id", "angle").orderBy("pos")
    first = F.min("pos").over(Window.partitionBy("job_id", "cut_id"))
    has = reels.select("job_id").distinct().withColumn("_reel", F.lit(True))
    rows = cuts.withColumns({"_first": first, "_in": F.lag("source_in").over(by_angle), "_out": F.lag("source_out").over(by_angle)}).join(has, "job_id", "left")
    rules = F.array(
        F.when(F.col("pos") > F.col("_first"), "duplicate_id"),
        F.when(F.col("source_out") <= F.col("source_in"), "empty"),
        F.when(F.col("source_in") < F.col("_in"), "out_of_order").when(F.col("source_in") < F.col("_out") - 1e-6, "overlap"),
        F.when((F.col("angle") == "B") & F.col("_reel").isNull(), "no_b_reel"),
    )
    return rows.select("job_id", "pos", F.explode(rules).alias("rule")).filter("rule is not null")


def validate_media(cuts: DataFrame, sources: DataFrame, reel: DataFrame) -> DataFrame:
    """job_id, pos, rule: missing source, A past its file, B past its reel, and notes where a cut crosses files (first boundary).

    sources(job_id, a_len, b_len), reel(job_id, start, end)
    """
    s = cuts.join(sources, "job_id", "left")
    length = F.when(F.col("angle") == "A", F.col("a_len")).otherwise(F.col("b_len"))
    bad = s.select("job_id", "pos", F.when(length.isNull(), "missing_source").when(F.col("source_out") > length + 1e-6, F.concat(F.lower("angle"), F.lit("_past_end"))).alias("rule"), F.lit(None).cast("double").alias("at"))
    edge = reel.select("job_id", F.col("start").alias("edge"), F.col("start").alias("edge2")).filter("edge > 0")
    crossing = overlap(cuts.filter("angle = 'B'"), edge, "job_id", ("source_in", "source_out"), ("edge", "edge2"), 64.0, closed=True).filter("edge > source_in and edge < source_out")
    notes = crossing.groupBy("job_id", "pos").agg(F.lit("crosses_file").alias("rule"), F.min("edge").alias("at"))
    return bad.unionByName(notes).filter("rule is not null")


def validate_pregrades(points: DataFrame, sources: DataFrame) -> DataFrame:
    """job_id, source, i, rule: undeclared source, time or gain that is no number, times not strictly rising.

    points(job_id, source, i, t_text, gain_text), sources(job_id, source)
    """
    rows = points.withColumns({"t": F.col("t_text").try_cast("double"), "gain": F.col("gain_text").try_cast("double")})
    w = Window.partitionBy("job_id", "source").orderBy("i")
    declared = sources.select("job_id", "source").distinct().withColumn("_ok", F.lit(True))
    rows = rows.withColumn("_prev", F.lag("t").over(w)).join(declared, ["job_id", "source"], "left")
    rules = F.array(
        F.when(F.col("_ok").isNull(), "undeclared_source"),
        F.when(F.col("t").isNull() | F.isnan("t"), "bad_time"),
        F.when(F.col("gain").isNull() | F.isnan("gain"), "bad_gain"),
        F.when(F.col("t") <= F.col("_prev"), "not_rising"),
    )
    return rows.select("job_id", "source", "i", F.explode(rules).alias("rule")).filter("rule is not null")


def validate_spans(spans: DataFrame, sources: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """job_id, pos, rule for spans (job_id, pos, start, dur) against source lengths (job_id, length)."""
    rows = spans.join(sources, "job_id", "left")
    rule = F.when(F.col("start") < 0, "negative_start").when(F.col("dur") <= 0, "no_duration").when(F.col("length").isNull(), "missing_source").when(F.col("start") + F.col("dur") > F.col("length") + tolerance, "past_end")
    return rows.select("job_id", "pos", rule.alias("rule")).filter("rule is not null")


def manifest_verdict(jobs: DataFrame, violations: DataFrame, notes: tuple[str, ...] = ("crosses_file",)) -> DataFrame:
    """job_id, valid, errors, notes: rules by name and number, comma-joined; jobs without a violation are valid."""
    g = violations.groupBy("job_id", "rule").agg(F.count("*").alias("n")).withColumn("text", F.concat("rule", F.lit("="), "n"))
    note = F.col("rule").isin(*notes)
    by_job = g.groupBy("job_id").agg(F.array_join(F.array_sort(F.collect_list(F.when(~note, F.col("text")))), ",").alias("errors"), F.array_join(F.array_sort(F.collect_list(F.when(note, F.col("text")))), ",").alias("notes"))
    out = jobs.select("job_id").distinct().join(by_job, "job_id", "left")
    return out.select("job_id", (F.coalesce("errors", F.lit("")) == "").alias("valid"), F.coalesce("errors", F.lit("")).alias("errors"), F.coalesce("notes", F.lit("")).alias("notes"))


def sequence_check(files: DataFrame, pattern: str, expected: DataFrame) -> DataFrame:
    """job_id, idx, problem: names off the pattern (idx null), repeated, missing or unexpected numbers. expected(job_id, first, n)."""
    parsed = files.withColumn("idx", F.when(F.col("name").rlike(pattern), F.regexp_extract("name", pattern, 1).cast("bigint")))
    off = parsed.filter("idx is null").select("job_id", "idx", F.lit("bad_name").alias("problem"))
    have = parsed.filter("idx is not null").groupBy("job_id", "idx").agg(F.count("*").alias("k"))
    want = expected.filter("n > 0").select("job_id", F.explode(F.expr("sequence(first, first + n - 1)")).alias("idx"))
    again = have.filter("k > 1").select("job_id", "idx", F.lit("duplicate").alias("problem"))
    missing = want.join(have, ["job_id", "idx"], "left_anti").withColumn("problem", F.lit("missing"))
    extra = have.join(want, ["job_id", "idx"], "left_anti").select("job_id", "idx", F.lit("out_of_range").alias("problem"))
    return off.unionByName(again).unionByName(missing).unionByName(extra)


def lint_commands(commands: DataFrame) -> DataFrame:
    """cmd_id, rule: each rule that a media command (cmd_id, cmd) breaks; its words are parted by white space."""
    words = F.split(F.trim("cmd"), r"\s+")
    has = lambda w: F.array_contains("words", w)
    starts = lambda p: F.exists("words", lambda w: w.startswith(p))
    after = lambda option, value: F.col("cmd").rlike(rf"(^|\s){option}\s+{value}(\s|$)")
    inputs = F.size(F.regexp_extract_all("cmd", F.lit(r"(?:^|\s)-i(?=\s+\S)"), F.lit(0)))
    labels = F.transform(F.regexp_extract_all("cmd", F.lit(r"\[(\d+):[vas]\]"), F.lit(1)), lambda x: x.cast("int"))
    copied = after(r"-c(:[va](:\d+)?)?", "copy")
    listed = (F.try_element_at("words", (F.array_position("words", F.lit("-f")) + 1).cast("int")) == "concat") & has("-f") & (inputs > 0)
    rules = {  # fixed values: the rules' names, options and levels
        "streamloop-shortest": has("-stream_loop") & has("-shortest"),
        "vaapi-concat": (has("h264_vaapi") | has("-vaapi_device")) & (listed | starts("concat=")) & (inputs > 1),
        "stream-label-mismatch": (inputs > 0) & (F.array_max(labels) >= inputs),
        "copy-encoder-opts": copied & (has("-pix_fmt") | starts("-pix_fmt=") | has("-profile:v") | starts("-profile:v=")),
        "scale-vaapi-unsupported": F.col("cmd").contains("scale_vaapi"),
        "limiter-095-locked-chain": F.col("cmd").contains("alimiter=limit=0.95"),
        "aac-192k-locked-chain": (starts("-c:v") | has("-movflags")) & (after("-b:a", "192k") | has("-b:a=192k")),
    }
    hits = F.array(*(F.when(broken, name) for name, broken in rules.items()))
    return commands.withColumn("words", words).select("cmd_id", F.explode(hits).alias("rule")).filter("rule is not null")


def mixed_concat_lists(members: DataFrame) -> DataFrame:
    """list_id of concat lists whose members (list_id, signature) differ."""
    return members.groupBy("list_id").agg(F.count_distinct("signature").alias("kinds")).filter("kinds > 1")


def scan_logs(logs: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """log_id, pattern, line (from 1) for each line of a log (log_id, text) that matches a fatal pattern."""
    lines = logs.select("log_id", F.posexplode(F.split("text", "\n")).alias("line", "body"))
    hits = F.array(*(F.when(F.col("body").rlike(p), n) for n, p in patterns.items()))
    return lines.select("log_id", (F.col("line") + 1).alias("line"), F.explode(hits).alias("pattern")).filter("pattern is not null")


def structure_violations(documents: DataFrame, required: dict[str, str], known: tuple[str, ...]) -> DataFrame:
    """doc_id, path, rule for JSON documents (doc_id, json): parse errors, missing, ill-typed and unknown top-level fields.

    required: field to a pattern of its text (numbers and strings are seen as text).
    """
    v = documents.withColumn("v", F.try_parse_json("json"))
    keys = F.json_object_keys("json")
    broken = v.filter("v is null").select("doc_id", F.lit("$").alias("path"), F.lit("not_json").alias("rule"))
    checks = []
    for field, pattern in required.items():
        text = F.get_json_object("json", f"$.{field}")
        checks.append(F.struct(F.lit(f"$.{field}").alias("path"), F.when(text.isNull(), "missing").when(~text.rlike(pattern), "pattern").alias("rule")))
    fine = v.filter("v is not null")
    declared = fine.select("doc_id", F.explode(F.array(*checks)).alias("c")).select("doc_id", "c.path", "c.rule").filter("rule is not null")
    unknown = fine.select("doc_id", F.explode(F.array_except(keys, F.array(*(F.lit(k) for k in known)))).alias("k")).select("doc_id", F.concat(F.lit("$."), "k").alias("path"), F.lit("unknown").alias("rule"))
    return broken.unionByName(declared).unionByName(unknown)


def manifest_violations(documents: DataFrame, rules: dict[str, dict] = MANIFEST_RULES) -> DataFrame:
    """doc_id, path, rule, field: places of JSON documents (doc_id, json) that break the rules, at any level.

    A place breaks one rule at most, the first of: type, among, missing and unknown (field: the first such member), length, pattern, range, items. What
    lies under it is not looked at, so only the outermost fault of a branch is told. A text that isn't JSON, null included, is 'not_json' at $.
    The rules are a small table that each level of the documents is joined with; there are as many steps as the rules have levels.
    """
    ddl = "kinds array<string>, among array<string>, required array<string>, fields array<string>, closed boolean, least_length int, most_length int, pattern string, least double, most double, least_items int"
    names = [c.split()[0] for c in ddl.split(", ")]
    table = documents.sparkSession.createDataFrame([(at, *(r.get(n) for n in names)) for at, r in rules.items()], f"at string, {ddl}")
    known = F.array(*(F.lit(at) for at in rules))
    fault = "struct<rule: string, field: string>"
    whole = F.to_json(F.try_parse_json("json"))
    bad = F.when(whole.isNull(), F.struct(F.lit("not_json").alias("rule"), F.lit(None).cast("string").alias("field")))
    rows = documents.select("doc_id", F.lit("$").alias("path"), F.lit("$").alias("at"), whole.alias("j"), bad.alias("fault"))
    first = F.substring("j", 1, 1)
    kind = F.when(first == "{", "object").when(first == "[", "array").when(first == '"', "string").when(first.isin("t", "f"), "boolean").when(first == "n", "null").otherwise("number")
    value = F.try_variant_get(F.try_parse_json("j"), "$", "string")
    number = value.try_cast("double")
    lost, more = F.try_element_at(F.array_except("required", "keys"), F.lit(1)), F.try_element_at(F.array_except("keys", "fields"), F.lit(1))
    is_text, is_number = F.col("kind") == "string", F.col("kind") == "number"
    plain = F.when(is_number, F.regexp_replace(value, r"^(-?[0-9]+)\.0+$", "$1")).otherwise(value)
    told = lambda name, field=None: F.struct(F.lit(name).alias("rule"), (F.lit(None).cast("string") if field is None else field).alias("field"))
    broken = (
        F.when(~F.array_contains("kinds", F.col("kind")), told("type"))
        .when(~F.array_contains("among", plain), told("among"))
        .when(lost.isNotNull(), told("missing", lost))
        .when(F.col("closed") & more.isNotNull(), told("unknown", more))
        .when(is_text & ((F.char_length(value) < F.col("least_length")) | (F.char_length(value) > F.col("most_length"))), told("length"))
        .when(is_text & ~F.rlike(value, F.col("pattern")), told("pattern"))
        .when(is_number & ((number < F.col("least")) | (number > F.col("most"))), told("range"))
        .when(F.json_array_length("j") < F.col("least_items"), told("items"))
    )
    for _ in range(1 + max(at.count(".") + at.count("[") for at in rules)):
        at = rows.join(F.broadcast(table), "at", "left").withColumns({"kind": kind, "keys": F.json_object_keys("j")})  # a row a rule
        at = at.withColumn("fault", F.when(F.col("at").isNull() | F.col("fault").isNotNull(), F.col("fault")).otherwise(broken))

        def under(x: Column) -> Column:
            named = F.concat("at", F.lit("."), x["k"])
            place = F.when(x["k"].isNull(), F.concat("at", F.lit("[*]"))).when(F.array_contains("fields", x["k"]), named).otherwise(F.concat("at", F.lit(".*")))
            return F.struct(x["path"].alias("path"), place.alias("at"), x["j"].alias("j"), F.lit(None).cast(fault).alias("fault"))

        inner = F.filter(F.transform(json_children(F.col("path"), F.col("j")), under), lambda x: F.array_contains(known, x["at"]))
        none = F.lit(None).cast("string")
        rest = F.when(F.col("fault").isNotNull(), F.array(F.struct("path", none.alias("at"), none.alias("j"), "fault"))).when(F.col("at").isNotNull(), inner)
        rows = at.select("doc_id", F.explode(rest).alias("x")).select("doc_id", "x.*")
    return rows.filter("fault is not null").select("doc_id", "path", "fault.rule", "fault.field")
