"""Catalogue maintenance and tolerant imports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scan_inventory(spark: SparkSession, root: str, extensions: list[str]) -> DataFrame:
    """path, size, mtime of files under root with one of the extensions; hidden and AppleDouble files are skipped. File contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    name = F.element_at(F.split("path", "/"), -1)
    return files.filter(~name.startswith(".") & name.rlike(r"(?i)\.(" + "|".join(extensions) + ")$")).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def changed_files(inventory: DataFrame, catalog: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Files (path, size, mtime) that the catalogue doesn't hold indexed with the same size and nearly the same time."""
    c = catalog.filter("status = 'indexed'").select(F.col("path").alias("_p"), F.col("size").alias("_s"), F.col("mtime").alias("_m"))
    same = (F.col("path") == F.col("_p")) & (F.col("size") == F.col("_s")) & (F.abs(F.col("mtime") - F.col("_m")) < tolerance)
    return inventory.join(c, same, "left_anti")


def hash_gate(files: DataFrame, catalog: DataFrame, max_retries: int = 3) -> DataFrame:
    """path, sha, gate for files (path, content): duplicate (not the first path of its hash), known, quarantined, retry or new. catalog(sha, status, retries)."""
    sha = F.sha2("content", 256)
    first = F.min("path").over(Window.partitionBy("sha"))
    rows = files.select("path", sha.alias("sha")).withColumn("_first", first).join(catalog.select("sha", "status", "retries"), "sha", "left")
    gate = F.when(F.col("path") != F.col("_first"), "duplicate").when(F.col("status") == "indexed", "known").when((F.col("status") == "quarantined") | (F.col("retries") >= max_retries), "quarantined").when(F.col("status").isNotNull(), "retry").otherwise("new")
    return rows.select("path", "sha", gate.alias("gate"))


def upsert_catalog(catalog: DataFrame, batch: DataFrame, kept: tuple[str, ...] = ("tags", "notes")) -> DataFrame:
    """The catalogue with the batch's technical columns; columns in `kept` stay as the catalogue has them. Key: path."""
    old = catalog.select(F.col("path"), *(F.col(c).alias(f"_o_{c}") for c in catalog.columns if c != "path"), F.lit(True).alias("_old"))
    new = batch.select(F.col("path"), *(F.col(c).alias(f"_n_{c}") for c in batch.columns if c != "path"), F.lit(True).alias("_new"))
    both = old.join(new, "path", "full")

    def value(c: str) -> Column:
        if c in kept and c not in batch.columns:
            return F.col(f"_o_{c}")
        if c in kept:
            return F.when(F.col("_old"), F.col(f"_o_{c}")).otherwise(F.col(f"_n_{c}"))
        return F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")) if c in batch.columns else F.col(f"_o_{c}")

    return both.select("path", *(value(c).alias(c) for c in catalog.columns if c != "path"))


def prune(catalog: DataFrame, inventory: DataFrame, *children: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Catalogue and child tables (clip_id) without clips whose path vanished; and the vanished ones."""
    gone = catalog.join(inventory.select("path").distinct(), "path", "left_anti")
    ids = gone.select("clip_id")
    return [t.join(ids, "clip_id", "left_anti") for t in (catalog, *children)], gone


def seconds(timecode: Column) -> Column:
    """h:m:s, m:s or s as seconds; null where it is none."""
    parts = F.transform(F.split(timecode, ":"), lambda p: p.try_cast("double"))
    return F.when(F.size(parts) == 3, parts[0] * 3600 + parts[1] * 60 + parts[2]).when(F.size(parts) == 2, parts[0] * 60 + parts[1]).otherwise(parts[0])


def read_scenes(texts: DataFrame) -> DataFrame:
    """file, scene, start_s, end_s from scene lists (file, text): the header is the first line that begins with 'Scene'; columns go by name.

    Start and end come from the seconds columns, else from timecodes, the end else from start and duration; rows that end before they start are dropped.
    """
    lines = texts.select("file", F.posexplode(F.split("text", r"\r?\n")).alias("line", "body")).withColumn("cells", F.transform(F.split("body", ","), lambda c: F.trim(c)))
    head = lines.filter(F.lower("body").startswith("scene")).groupBy("file").agg(F.min_by(F.struct("line", F.transform("cells", lambda c: F.lower(c)).alias("names")), "line").alias("h"))
    rows = lines.join(head, "file").filter((F.col("line") > F.col("h.line")) & (F.trim("body") != ""))
    def cell(name: str) -> Column:
        return F.when(F.array_contains("h.names", name), F.try_element_at("cells", F.array_position("h.names", F.lit(name)).cast("int")))

    start = F.coalesce(cell("start time (seconds)").try_cast("double"), seconds(cell("start timecode")))
    end = F.coalesce(cell("end time (seconds)").try_cast("double"), seconds(cell("end timecode")), start + cell("length (seconds)").try_cast("double"))
    return rows.select("file", cell("scene number").try_cast("int").alias("scene"), start.alias("start_s"), end.alias("end_s")).filter("start_s is not null and end_s is not null and end_s >= start_s")


#: Field aliases in the order in which they are tried.
LISTS = ("beats", "shortlist", "results", "scenes", "segments", "items")
STARTS = ("time", "start", "start_s", "t", "timestamp", "beat_time", "frame_ts", "in", "start_time")
ENDS = ("end", "end_s", "out", "end_time", "duration", "dur")
DURATIONS = ("duration", "dur")
SCORES = ("score", "value", "confidence", "prob", "weight")


def read_sidecars(docs: DataFrame) -> DataFrame:
    """file, i, start_s, end_s, score from JSON sidecars (file, json): entries with a start, i their place among the list's objects.

    The list is the document itself, or the first of the known fields, else of all fields in order, whose list begins with an object.
    A start may be a number or a number's text, ends and scores are numbers; a duration means start + it. The first alias with a usable value counts.
    """
    fields = F.from_json("json", "map<string,string>")
    lists = F.filter(F.concat(F.array(*(F.col("f")[n] for n in LISTS)), F.coalesce(F.map_values("f"), F.array().cast("array<string>"))), lambda x: x.rlike(r"^\s*\[\s*\{"))
    rows = docs.withColumn("f", F.when(F.col("json").rlike(r"^\s*\{"), fields)).withColumn("l", F.when(F.col("json").rlike(r"^\s*\["), F.col("json")).otherwise(F.try_element_at(lists, F.lit(1))))
    entries = F.filter(F.try_variant_get(F.try_parse_json("l"), "$", "array<variant>"), lambda x: F.schema_of_variant(x).startswith("OBJECT"))
    x = rows.select("file", F.posexplode(entries).alias("i", "x"))
    kind = lambda n: F.schema_of_variant(F.try_variant_get("x", f"$.{n}", "variant"))
    number = lambda n, kinds="BIGINT|DOUBLE|FLOAT|DECIMAL.*": F.when(kind(n).rlike(f"^({kinds})$"), F.try_variant_get("x", f"$.{n}", "double"))
    start = F.coalesce(*(number(n, "BIGINT|DOUBLE|FLOAT|DECIMAL.*|STRING") for n in STARTS))
    end = F.coalesce(*(F.col("start_s") + number(n) if n in DURATIONS else number(n) for n in ENDS))
    return x.withColumn("start_s", start).filter("start_s is not null").select("file", "i", "start_s", end.alias("end_s"), F.coalesce(*map(number, SCORES)).alias("score"))


def load_beats(docs: DataFrame) -> DataFrame:
    """clip_id, t: beats given as numbers or as objects with time or t (clip_id, json), parsable ones, each once."""
    v = docs.withColumn("v", F.try_parse_json("json"))
    array = F.coalesce(F.try_variant_get("v", "$.beats", "array<variant>"), F.try_variant_get("v", "$", "array<variant>"))
    x = v.select("clip_id", F.explode(array).alias("x"))
    t = F.coalesce(F.try_variant_get("x", "$.time", "double"), F.try_variant_get("x", "$.t", "double"), F.try_variant_get("x", "$", "double"))
    return x.select("clip_id", t.alias("t")).filter("t is not null").distinct()


def words_to_notes(words: DataFrame, most: int = 4000) -> DataFrame:
    """clip_id, notes: the words (clip_id, seq, kind, word) of kind 'word' (or without one), in order, joined by spaces, trimmed to `most` characters."""
    w = words.filter(F.coalesce("kind", F.lit("word")) == "word")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "word"))), lambda x: x["word"]), " ")
    return w.groupBy("clip_id").agg(F.substring(joined, 1, most).alias("notes"))


def camera_source(df: DataFrame, name: str = "filename") -> DataFrame:
    """camera: from the prefix of the file's name, the last part of a path; null for others."""
    n = F.substring_index(name, "/", -1)
    return df.withColumn("camera", F.when(n.startswith("DJI_"), "dji").when(n.startswith("GP"), "gopro"))


def backfill_plan(clips: DataFrame, **stages: DataFrame) -> DataFrame:
    """clip_id, stage: stages (tables with clip_id and degraded) that a clip has no row of, or only degraded ones."""
    out = None
    for name, rows in stages.items():
        fine = rows.filter(~F.coalesce("degraded", F.lit(False))).select("clip_id").distinct()
        todo = clips.select("clip_id").join(fine, "clip_id", "left_anti").withColumn("stage", F.lit(name))
        out = todo if out is None else out.unionByName(todo)
    return out


def concat_cards(signals: DataFrame, reel: DataFrame) -> DataFrame:
    """Per-card samples (reel, idx, t, kind, ...) shifted onto the reel; reels that mix kinds are refused."""
    kinds = signals.groupBy("reel").agg(F.count_distinct("kind").alias("_kinds")).filter("_kinds = 1").select("reel")
    at = reel.select("reel", "idx", F.col("start").alias("_at"))
    return signals.join(kinds, "reel").join(at, ["reel", "idx"]).withColumn("t", F.col("t") + F.col("_at")).drop("_at")


def resume_union(stored: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows and fresh ones; where both have a key the fresh row counts, and no stored key is lost."""
    return fresh.unionByName(stored.join(fresh.select(*keys), keys, "left_anti"))


def package_index(files: DataFrame, purposes: dict[str, str]) -> DataFrame:
    """path, bytes, sha256, purpose of files (path, content): the first pattern that a path matches names its purpose; index.json is left out."""
    purpose = F.coalesce(*(F.when(F.col("path").rlike(p), n) for n, p in purposes.items()), F.lit("other"))
    return files.filter(~F.col("path").endswith("index.json")).select("path", F.octet_length("content").cast("bigint").alias("bytes"), F.sha2("content", 256).alias("sha256"), purpose.alias("purpose"))


def verify_hashes(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """path, state: ok, changed, missing (recorded, not there) or unrecorded, for (path, sha)."""
    both = recorded.select("path", F.col("sha").alias("_r")).join(current.select("path", F.col("sha").alias("_c")), "path", "full")
    return both.select("path", F.when(F.col("_r").isNull(), "unrecorded").when(F.col("_c").isNull(), "missing").when(F.col("_r") == F.col("_c"), "ok").otherwise("changed").alias("state"))


def fingerprint(df: DataFrame, fields: list[str]) -> DataFrame:
    """fingerprint: sha-256 of the fields' texts in canonical order, nulls marked."""
    return df.withColumn("fingerprint", F.sha2(F.concat_ws("|", *(F.concat(F.lit(f"{f}="), F.coalesce(F.col(f).cast("string"), F.lit("~"))) for f in sorted(fields))), 256))


def write_artifact(df: DataFrame, keys: list[str], order: list[str], path: str) -> None:
    """One JSON document per key with its rows nested in order."""
    rest = [c for c in df.columns if c not in keys]
    rows = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, *(c for c in rest if c not in order)))).alias("rows"))
    rows.write.mode("overwrite").json(path)
