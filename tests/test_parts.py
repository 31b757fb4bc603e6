"""Greedy picks by parts: the same picks as over whole clips, and a clip of a million runs."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from cutframe.functions.blocks import apart
from cutframe.operators import activity as ac
from cutframe.operators import timeline as tl


def plain_nms(runs, min_sep, min_len):
    kept = []
    for r in sorted((r for r in runs if r[4] + 1 - r[3] >= min_len), key=lambda r: (-r[1], r[0])):
        if all(not (r[3] < k[4] and r[4] > k[3]) and abs(r[3] - k[3]) >= min_sep for k in kept):
            kept.append(r)
    return sorted(r[0] for r in kept)


RUN = "clip_id int, n int, pk double, floor double, lo long, hi long, capped boolean"


def test_runs_by_parts(spark):
    rng = random.Random(6)
    clips = {c: [(n, rng.randint(1, 9) * 1.0, 0.0, lo, lo + rng.randint(0, 9)) for n in range(60) for lo in [rng.randrange(300)]] for c in range(8)}
    rows = spark.createDataFrame([(c, *r, False) for c, runs in clips.items() for r in runs], RUN)
    got = {}
    for r in ac.nms_runs(rows, 4, 2).collect():
        got.setdefault(r.clip_id, []).append(r.n)
    assert {c: sorted(n) for c, n in got.items()} == {c: plain_nms(runs, 4, 2) for c, runs in clips.items()}


def test_a_clip_of_a_million_runs(spark):
    rows = spark.range(1_000_000).select(F.lit(1).alias("clip_id"), F.col("id").cast("int").alias("n"), (F.col("id") % 7).cast("double").alias("pk"), F.lit(0.0).alias("floor"), (F.col("id") * 3 + F.floor(F.col("id") / 5) * 20).alias("lo"), F.lit(False).alias("capped"))
    rows = rows.withColumn("hi", F.col("lo") + 4)
    parts = apart(rows, ["clip_id"], F.col("lo"), F.greatest("hi", F.col("lo") + 4), ["n"]).groupBy("_part").count()
    assert parts.agg(F.max("count"), F.count("*")).first()[:] == (5, 200_000)
    assert ac.nms_runs(rows, 4, 2).select(F.count("*"), F.countDistinct("n")).first()[0] >= 400_000


def test_cuts_by_parts(spark):
    rng = random.Random(7)
    p = [(j, k, rng.random() * 60) for j in range(6) for k in range(25)]
    a = [(j, k, rng.random() * 60) for j in range(6) for k in range(25)]
    want = []
    for j in range(6):
        used = set()
        for _, pos, t in [x for x in p if x[0] == j]:
            near = sorted((abs(x[2] - t), x[1]) for x in a if x[0] == j and abs(x[2] - t) <= 1 and x[1] not in used)
            if near:
                used.add(near[0][1])
                want.append((j, pos, near[0][1]))
    df = lambda rows: spark.createDataFrame(rows, "job_id int, pos int, source_in double")
    got = tl.match_cuts(df(p), df(a)).select("job_id", "p_pos", "a_pos").collect()
    assert sorted(map(tuple, got)) == sorted(want)
