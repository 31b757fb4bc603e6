"""License scans with DataFrame functions only: rolling word k-gram hashes vote for diagonals of license templates.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased. Templates are short phrases and longer notices. One pass over
the texts makes a row for every rolling k-gram and joins its hash, and its words, to the templates' k-grams; k is `k`, or a
template's length where that is less. A hit at word i of a text and word j of a template votes for the diagonal i - j: a template that
stands in the text unchanged has all its votes on one diagonal, and each word added or lost moves the rest to a neighbouring one.
Votes are gathered by (text, template, diagonal), diagonals at most `drift` apart become one span, and a span is verified by what share of the
template's words its k-grams cover: notices of `whole_below` words or more need `least_share`, shorter ones and phrases all, on one diagonal.

Every place of a phrase counts, those that overlap too, and its label is given; labels of notices come on top. The score is the
largest share of a template that was accepted, 0 where none was. Hits are gathered by the text's digest, so copies of a text are decided
once and share the result; each row gets it, whatever its other columns hold. Null texts count as empty and have no place, no label and score 0; an
empty table gives an empty one. Input columns of the made names are replaced. Texts are read whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import attach, text_key, written

#: Base phrases with their labels.
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
#: Short names and notices of public licenses with their labels.
NOTICES = [
    ("gnu general public license version 2", "gpl-2.0"),
    ("gnu general public license version 3", "gpl-3.0"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("apache license version 2 0", "apache-2.0"),
    ("mozilla public license", "mpl"),
    ("cc by nc", "cc-by-nc"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nd", "cc-by-nd"),
    ("creative commons attribution", "cc-by"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so", "mit"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "bsd"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2.0"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", "apache-2.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "lgpl"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software", "unlicense"),
]
#: Templates up to so many words in all are sent to every task; more are joined by a shuffle.
BROADCAST_WORDS = 100_000

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def template_words(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, UPPER.lower())))


def words(text: Column) -> Column:
    """A text's words; what parts them leaves an empty string before the first and after the last, which are left out."""
    gaps = F.split(F.translate(text, UPPER, UPPER.lower()), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(gaps, lambda w: w != "")


def _gram(words: Column, i: Column, size: int) -> list[Column]:
    return [F.get(words, i + j) for j in range(size)]


def template_grams(spark: SparkSession, templates: list[tuple[str, str, bool]], k: int) -> tuple[DataFrame, list[int], int]:
    """(template, label, phrase, length, grams, at, h, g): a row for each k-gram of (text, label, is a phrase); the gram sizes; all words."""
    split = [(n, label, phrase, template_words(text)) for n, (text, label, phrase) in enumerate(templates)]
    split = [t for t in split if t[3]]
    table = F.array(*(F.struct(F.lit(n).alias("template"), F.lit(label).alias("label"), F.lit(phrase).alias("phrase"), F.array(*map(F.lit, w)).alias("w")) for n, label, phrase, w in split))
    sizes = sorted({min(k, len(w)) for *_, w in split})
    rows = spark.range(1).select(F.inline(table)).withColumn("length", F.size("w")).withColumn("size", F.least(F.lit(k), F.col("length")))
    rows = rows.withColumn("grams", F.col("length") - F.col("size") + 1).withColumn("at", F.explode(F.sequence(F.lit(0), F.col("length") - F.col("size"))))
    rows = rows.withColumn("g", F.slice("w", F.col("at") + 1, F.col("size")))
    return rows.select("template", "label", "phrase", "length", "size", "grams", "at", _hash(F.col("w"), F.col("at"), F.col("size"), sizes).alias("h"), "g"), sizes, sum(len(w) for *_, w in split)


def _hash(words: Column, i: Column, size: Column, sizes: list[int]) -> Column:
    of = F.lit(None).cast("bigint")
    for n in sizes:
        of = F.when(size == n, F.xxhash64(*_gram(words, i, n))).otherwise(of)
    return of


def hits(rows: DataFrame, spark: SparkSession, templates: list[tuple[str, str, bool]], k: int) -> DataFrame:
    """rows(kept, key, words) to (key, n_words, kept) once a row, without template, and (key, template, ..., i, at) for each k-gram that stands in a template too."""
    grams, sizes, total = template_grams(spark, templates, k)
    n = F.size("words")
    step = F.explode_outer(F.sequence(F.lit(-1), F.greatest(n - 1, F.lit(0)) * len(sizes) - 1))  # -1 is the row itself
    each = rows.select("kept", "key", "words", n.cast("bigint").alias("n_words"), step.alias("step"))
    i = F.floor(F.col("step") / len(sizes)).cast("int")
    size = F.get(F.array(*map(F.lit, sizes)), F.col("step") % len(sizes))
    each = each.withColumns({"i": i, "own": F.when(F.col("step") >= 0, size)})
    h = F.when(F.col("step") >= 0, _hash(F.col("words"), F.col("i"), F.col("own"), sizes)).otherwise(F.xxhash64("key"))
    grams = F.broadcast(grams) if total <= BROADCAST_WORDS else grams
    same = (F.col("own") == F.col("size")) & (F.slice("words", F.col("i") + 1, F.col("own")) == F.col("g"))
    met = each.withColumn("own_h", h).join(grams, (F.col("own_h") == F.col("h")) & same, "left")
    met = met.filter((F.col("step") < 0) | F.col("template").isNotNull())
    return met.select("key", F.when(F.col("step") < 0, F.col("kept")).alias("kept"), "n_words", "template", "label", "phrase", "length", "size", "grams", "i", "at")


def spans(met: DataFrame, drift: int, least_share: float, whole_below: int) -> DataFrame:
    """(key, template, label, phrase, start, end, share): verified spans from hits, in words, end exclusive."""
    shape = ["template", "label", "phrase", "length", "size", "grams"]
    votes = met.filter("template is not null").groupBy("key", *shape, (F.col("i") - F.col("at")).alias("diagonal")).agg(F.collect_set("at").alias("at"))
    whole = votes.filter("size(at) = grams").select("key", "template", "label", "phrase", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("length")).alias("end"), F.lit(1.0).alias("share"))
    whole = whole.filter(F.col("phrase") | (F.col("length") < whole_below))
    along = Window.partitionBy("key", "template").orderBy("diagonal")
    long = votes.filter(~F.col("phrase") & (F.col("length") >= whole_below))
    long = long.withColumn("apart", (F.col("diagonal") - F.lag("diagonal").over(along) > drift).cast("int"))
    long = long.withColumn("island", F.sum(F.coalesce("apart", F.lit(0))).over(along))
    long = long.groupBy("key", *shape, "island").agg(
        F.min(F.col("diagonal") + F.array_min("at")).alias("start"),
        F.max(F.col("diagonal") + F.array_max("at") + F.col("size")).alias("end"),
        F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda a: F.sequence(a, a + F.col("size") - 1)))))
    long = long.withColumn("share", covered / F.col("length")).filter(F.col("share") >= least_share)
    return whole.unionByName(long.select(*whole.columns))


def scan(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, str]] = NOTICES, k: int = 3, drift: int = 3, least_share: float = 0.75, whole_below: int = 20) -> DataFrame:
    """Rows of docs (columns `keep`, by default all) with n_words, n_base, first_word, last_word, base_labels, labels, score and
    spans, an array of (label, start, end, share) in order."""
    made = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    names = attach(docs.columns if keep is None else keep, made)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in names)).alias("kept"), text_key(body).alias("key"), words(body).alias("words"))
    met = written(hits(rows, docs.sparkSession, [(t, label, True) for t, label in phrases] + [(t, label, False) for t, label in notices], k), "license-hits")
    found = spans(met, drift, least_share, whole_below)
    base = F.when(F.col("phrase"), F.col("start")).cast("bigint")
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    told = found.groupBy("key").agg(
        F.count(base).alias("n_base"),
        F.min(base).alias("first_word"),
        F.max(base).alias("last_word"),
        joined(F.collect_set(F.when(F.col("phrase"), F.col("label")))).alias("base_labels"),
        joined(F.collect_set("label")).alias("labels"),
        F.max("share").alias("score"),
        F.array_sort(F.collect_list(F.struct(F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), "label", "share"))).alias("spans"),
    )
    told = written(told, "license-labels")  # so that a text's many copies can be split in the join
    none = {"n_base": F.lit(0).cast("bigint"), "base_labels": F.lit(""), "labels": F.lit(""), "score": F.lit(0.0), "spans": F.array().cast("array<struct<start:bigint,end:bigint,label:string,share:double>>")}
    out = met.filter("template is null").select("key", "kept", "n_words").join(told, "key", "left")
    value = lambda c: F.coalesce(F.col(c), none[c]) if c in none else F.col(c)
    return out.select(*(F.col("kept").getField(c).alias(c) for c in names), *(value(c).alias(c) for c in made))
