"""Hand-made cases of rules whose queries see few of their edges."""

from __future__ import annotations

import json

import pytest

from cutframe.operators import candidates, colour, music, validate, windows
from cutframe.sources import catalog
from cutframe.streaming import jobs

COMMANDS = {
    "-stream_loop -1 -i x.mp4 -c copy -shortest out.mp4": ["streamloop-shortest"],
    "-stream_loop -1 -i x.mp4 -t 5 -c copy out.mp4": [],
    "-vaapi_device /dev/dri/renderD128 -i a.mp4 -i b.mp4 -f concat -safe 0 -i list.txt -c:v h264_vaapi out.mp4": ["vaapi-concat"],
    "-f concat -safe 0 -i list.txt -c:v h264_vaapi out.mp4": [],
    "-i a.mp4 -filter_complex [2:v]scale=640:360[v] -map [v] out.mp4": ["stream-label-mismatch"],
    "-i a.mp4 -filter_complex [0:s]null[v] out.mp4": [],
    "-i a.mp4 -c:v copy -pix_fmt yuv420p out.mp4": ["copy-encoder-opts"],
    "-i a.mp4 -c:v copy -crf 20 out.mp4": [],
    "-i a.mp4 -c:a:0 copy -profile:v=high out.mp4": ["copy-encoder-opts"],
    "-i a.mp4 -vf hwupload,scale_vaapi=w=1920:h=1080 -c:v h264_vaapi out.mp4": ["scale-vaapi-unsupported"],
    "-i a.mp4 -i b.mp4 -filter_complex [1:a]loudnorm=I=-13.5,alimiter=limit=0.95:level=false[a] -map [a] out.mp4": ["limiter-095-locked-chain"],
    "-i a.mp4 -af alimiter=limit=0.97 out.mp4": [],
    "-i a.mp4 -c:v libx264 -c:a aac -b:a 192k -movflags +faststart out.mp4": ["aac-192k-locked-chain"],
    "-i a.mp4 -c:v libx264 -c:a aac -b:a 320k -movflags +faststart out.mp4": [],
    "-i a.mp4 -vn -c:a aac -b:a 192k out.m4a": [],
    "": [],
}


def test_command_rules(spark):
    got = {i: [] for i in range(len(COMMANDS))}
    for r in validate.lint_commands(spark.createDataFrame(list(enumerate(COMMANDS)), "cmd_id int, cmd string")).collect():
        got[r.cmd_id].append(r.rule)
    assert [got[i] for i in got] == list(COMMANDS.values())


@pytest.mark.parametrize(
    ("document", "rows"),
    [
        ([1, {"time": "1.5", "t": 9, "duration": 2, "value": 3, "score": "x"}, {"score": 1}, {"in": 4, "out": 6, "end_time": 9, "prob": 0.5}], [(0, 1.5, 3.5, 3.0), (2, 4.0, 6.0, 0.5)]),
        ({"beats": [], "x": [{"frame_ts": 1}], "items": [{"start_time": 2, "end": "3", "weight": 1}]}, [(0, 2.0, None, 1.0)]),
        ({"first": [1, 2], "second": [{"timestamp": True, "start": 7}]}, [(0, 7.0, None, None)]),
        ({"beats": [3, {"t": 1}]}, []),
        ({"beats": {"t": 1}}, []),
    ],
)
def test_sidecar_aliases(spark, document, rows):
    got = catalog.read_sidecars(spark.createDataFrame([("f", json.dumps(document)), ("g", "[broken"), ("h", None)], "file string, json string")).collect()
    assert sorted((r.i, r.start_s, r.end_s, r.score) for r in got) == rows


def test_camera_prefixes(spark):
    names = {"DJI_1.mov": "dji", "a/GP1.mp4": "gopro", "GX01.mp4": None, "GOPR1.mp4": None, "dji_1.mov": None, "GP/x.mov": None, "aDJI_1": None}
    rows = catalog.camera_source(spark.createDataFrame([(n,) for n in names], "filename string")).collect()
    assert {r.filename: r.camera for r in rows} == names


def test_missing_scores_count_nothing(spark):
    names = list(candidates.WEIGHTS)
    rows = [(1, 0, "c1", *([0.5] * 7), None), (1, 0, "c2", *([None] * 7), 1.0), (1, 1, "c3", *([None] * 8))]
    df = spark.createDataFrame(rows, "job_id int, event int, candidate_id string, " + ", ".join(f"{n} double" for n in names))
    got = {r.event: (r.recommended, r.w) for r in candidates.recommend(df).collect()}
    assert got == {0: ("c1", round(0.5 * (1 - candidates.WEIGHTS[names[7]]), 6)), 1: ("c3", 0.0)}


def test_events_inside_a_span(spark):
    grid = lambda ts: spark.createDataFrame([(c, float(t)) for c in (1, 2) for t in ts], "clip_id int, t double")
    spans = spark.createDataFrame([(1, 0.0, 12.0), (2, 4.0, 8.0)], "clip_id int, lo double, hi double")
    got = music.pick_events(grid(range(0, 20, 4)), grid([x * 0.1 for x in range(200)]), spans, 0.3, 3).collect()
    assert sorted((r.clip_id, round(r.t, 6), r.kind) for r in got) == [(1, 0.0, "downbeat"), (1, 4.0, "downbeat"), (1, 8.0, "downbeat"), (2, 4.0, "beat"), (2, 4.3, "beat"), (2, 4.6, "beat")]


def test_job_states(spark):
    log = [(1, 1, "proposed", None), (2, 1, "approved", None), (3, 1, "approved", None), (3, 2, "executing", None), (4, 1, "approved", None), (4, 9, "approved", None), (5, 5, "approved", None), (5, 6, "executing", None), (5, 7, "failed", "no space"), (6, 1, "done", None)]
    log += [(7, 1, "approved", None), (7, 2, "executing", None), (7, 3, "failed", "a"), (7, 4, "approved", None), (8, 1, "approved", None), (8, 2, "executing", None), (8, 3, "failed", "a"), (8, 4, "approved", None), (8, 5, "executing", None), (8, 6, "done", None)]
    own = spark.createDataFrame([(1, None), (2, "p2"), (4, "p4"), (5, "p5"), (6, "p6"), (7, None)], "job_id int, project string")
    flags = spark.createDataFrame([("p4", 5), ("p5", 5), ("p5", 8), (None, 1)], "project string, at int")
    got = {r[0]: tuple(r)[1:] for r in jobs.job_state(spark.createDataFrame(log, "job_id int, at int, status string, error string"), own, flags).collect()}
    assert got == {
        1: ("proposed", False, None, 1, 0),  # no project: never blocked
        2: ("proposed", True, None, 0, 1),
        3: ("executing", False, None, 0, 0),
        4: ("approved", False, None, 0, 1),  # refused before the flag, taken after it
        5: ("failed", False, "no space", 0, 0),
        6: ("proposed", True, None, 1, 0),
        7: ("approved", False, "a", 0, 0),  # a failure's text stays until the job is done
        8: ("done", False, None, 0, 0),
    }
    state = spark.createDataFrame([(i, *x[:2]) for i, x in got.items()], "job_id int, status string, blocked boolean")
    assert [r.job_id for r in jobs.job_listing(state, "proposed").collect()] == [6, 2, 1] and jobs.job_listing(state).count() == 8


def test_best_windows_order_then_freedom_then_reuse(spark):
    slots = spark.createDataFrame([(1, k, float(lo), float(hi)) for k, (lo, hi) in enumerate([(0, 14), (0, 14), (0, 14), (0, 3), (0, 14), (16, 30), (10, 16), (40, 50)])], "job_id long, slot int, lo double, hi double")
    segs = spark.createDataFrame([(1, 0.0, 10.0, 1.0), (1, 10.0, 30.0, 0.5), (2, 0.0, 9.0, 1.0)], "job_id long, s0 double, s1 double, score double")
    got = {r.slot: (r.state, r.w0, r.w1, r.score) for r in windows.best_windows(slots, segs, least=4.0, most=8.0).collect()}
    assert got == {
        0: ("ordered", 0, 4, 1),
        1: ("ordered", 4, 8, 1),
        2: ("ordered", 8, 12, 0.75),
        3: ("none", None, None, None),
        4: ("reused", 0, 8, 1),
        5: ("ordered", 16, 20, 0.5),
        6: ("unordered", 12, 16, 0.5),
        7: ("ordered", 40, 44, None),
    }
    assert windows.best_windows(slots.limit(0), segs, least=4.0, most=8.0).count() == 0


def test_gain_fit_against_a_loop(spark):
    hist = {(w, ch): {v: (v * (w + 3) + ch) % 7 for v in range(5 * w, 200, 9)} for w in range(4) for ch in range(2)}
    lut = {(ch, v): min(255.0, v * v / 255 + 3 * ch) for ch in range(2) for v in range(256)}
    target = {k: 30.0 + 25 * k[0] for k in hist}
    want = {}
    for (w, ch), counts in hist.items():
        gain = 1.0
        for _ in range(4):
            total = sum(n * lut[ch, min(255, int(v * gain + 0.5))] for v, n in counts.items())
            ratio = target[w, ch] * sum(counts.values()) / total
            if abs(ratio - 1) <= 0.01:
                break
            gain *= ratio
        want[w, ch] = gain
    frame = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    got = colour.fit_gains(
        frame([(*k, v, n) for k, c in hist.items() for v, n in c.items()], "window_id int, ch int, v int, n int"),
        frame([(*k, x) for k, x in lut.items()], "ch int, v int, out double"),
        frame([(*k, x) for k, x in target.items()], "window_id int, ch int, target double"),
    )
    assert {(r.window_id, r.ch): r.gain for r in got.collect()} == pytest.approx(want, rel=1e-6)


def test_manifest_places(spark):
    cut = {"id": "cut_001", "angle": "A", "source_in": 0, "source_out": 5.5}
    good = {"manifest_version": 1, "job_id": "mix_1", "template": "t", "sources": {"a_reel": "a.mov"}, "timeline": [cut], "profiles": dict.fromkeys(["grade", "crop", "graphics", "audio"], "p")}
    points = {"mode": "time_varying", "points": [{"t": 1, "curve": "c", "note": 1}], "own": {"x": 1}}
    cases = [
        (good, []),
        (good | {"pre_grades": {"a.mov": "curves", "b.mov": points}, "postflight": {"status": "passed", "pre_grades_applied": {"a": {"x": True}}}}, []),
        (good | {"manifest_version": 1.0}, []),
        (good | {"manifest_version": True, "job_id": "-x"}, [("$.job_id", "pattern", None), ("$.manifest_version", "type", None)]),
        (good | {"job_id": "j" * 65, "template": ""}, [("$.job_id", "length", None), ("$.template", "length", None)]),
        (good | {"sources.a_reel": 1, "template": ""}, [("$", "unknown", "sources.a_reel")]),
        (good | {"sources": {"b_reel": ["", 1]}}, [("$.sources", "missing", "a_reel")]),
        (good | {"sources": {"a_reel": "a", "b_reel": ["", 1]}}, [("$.sources.b_reel[0]", "length", None), ("$.sources.b_reel[1]", "type", None)]),
        (good | {"timeline": []}, [("$.timeline", "items", None)]),
        (good | {"timeline": [cut, cut | {"id": "cut_1", "angle": "C", "source_in": -1, "confidence": "mid"}, cut | {"x": 1}, "y"]}, [("$.timeline[1].angle", "among", None), ("$.timeline[1].confidence", "among", None), ("$.timeline[1].id", "pattern", None), ("$.timeline[1].source_in", "range", None), ("$.timeline[2]", "unknown", "x"), ("$.timeline[3]", "type", None)]),
        (good | {"pre_grades": {"a": "", "b": 1, "c": {"mode": "x"}, "d": points | {"max_chunk_s": 601, "points": [{"t": "1", "curve": ""}]}}}, [("$.pre_grades.a", "length", None), ("$.pre_grades.b", "type", None), ("$.pre_grades.c", "missing", "points"), ("$.pre_grades.d.max_chunk_s", "range", None), ("$.pre_grades.d.points[0].curve", "length", None), ("$.pre_grades.d.points[0].t", "type", None)]),
        (good | {"postflight": {"status": "done", "bt709": {"primaries": 1}}}, [("$.postflight.bt709.primaries", "type", None), ("$.postflight.status", "among", None)]),
        ([good], [("$", "type", None)]),
    ]
    docs = [(i, json.dumps(c)) for i, (c, _) in enumerate(cases)] + [(100, "{"), (101, None), (102, "")]
    got = {i: [] for i, _ in docs}
    for r in validate.manifest_violations(spark.createDataFrame(docs, "doc_id long, json string")).collect():
        got[r.doc_id].append((r.path, r.rule, r.field))
    assert {i: sorted(x) for i, x in got.items()} == {i: w for i, (_, w) in enumerate(cases)} | {i: [("$", "not_json", None)] for i in (100, 101, 102)}
