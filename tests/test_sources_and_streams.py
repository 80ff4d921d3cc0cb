import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempoloom.functions import scalars
from tempoloom.operators import audit, catalog, evaluate, smoothing, timeline
from tempoloom.plans import assemble, config
from tempoloom.schema import INVENTORY, feature_names
from tempoloom.sources import readers, sinks
from tempoloom.streaming import filters

from .test_timeline import rows


def test_annotations(spark, tmp_path):
    good = tmp_path / "NOVA project" / "gestures.annotation~"
    good.parent.mkdir()
    good.write_text("0.0; 0.2; 10; 0.9;\n\n1.0;1.4;-1;\n2;2.5;12;1.0;\n")
    got = readers.annotations(spark, str(tmp_path), "*.annotation~")
    assert [tuple(r)[1:] for r in got.orderBy("line_no").collect()] == [(1, 0.0, 0.2, 10, 0.9), (3, 1.0, 1.4, 14, 1.0), (4, 2.0, 2.5, 12, 1.0)]
    good.write_text("0;1;2\n0;1;99\nx;1;2\n3;1;2\n1;2\n")
    lenient = readers.annotations(spark, str(tmp_path), "*.annotation~", strict=False)
    assert [r.error is None for r in lenient.orderBy("line_no").collect()] == [True, False, False, False, False]
    assert readers.annotation_errors(lenient).first().bad_lines == 4
    with pytest.raises(Exception, match="gestures.annotation~:2 "):
        readers.annotations(spark, str(tmp_path), "*.annotation~").where("line_no <= 2").collect()


def test_dirty_list(spark, tmp_path):
    p = tmp_path / "dirty.txt"
    p.write_bytes("﻿# comment\nsrc\\a b\nsrc/c/d\n\n".encode())
    assert rows(readers.dirty_list(spark, str(p)), "video_id") == [("src__a b",), ("src__c__d",)]
    p.write_text("missing\nsource//sample\nok/ok\n")
    with pytest.raises(ValueError, match="lines 1, 2"):
        readers.dirty_list(spark, str(p))


def test_inventory_of_a_tree(spark, tmp_path):
    def put(path, text="x"):
        p = tmp_path / path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)

    put("s1/batch/S1_F_meta_lie-up_x/b.MP4")
    put("s1/batch/S1_F_meta_lie-up_x/a.mp4")
    put("s1/batch/S1_F_meta_lie-up_x/NOVA project/gestures.annotation~", "0;1;2\n")
    put("s1/bad/clip.mp4")
    put("s1/S2_M_meta_pen/deep/er/notes.txt")
    t = catalog.taxonomy_frame(spark, {"exact": {"lie-up": "positive", "pen": "negative"}, "aliases": {}})
    got = {r.video_id: r for r in catalog.training_inventory(readers.listing(spark, str(tmp_path)), str(tmp_path), t, ["s1", "gone"]).collect()}
    assert set(got) == {"s1__batch__S1_F_meta_lie-up_x", "s1__bad", "s1__S2_M_meta_pen", "gone"}
    ok = got["s1__batch__S1_F_meta_lie-up_x"]
    assert (ok.status, ok.scene, ok.polarity, ok.error) == ("ok", "lie-up", "positive", None) and ok.video_path.endswith("/a.mp4") and ok.annotation_path.endswith("gestures.annotation~")
    assert got["s1__bad"].error == "invalid_name;missing_nova_annotation" and got["s1__S2_M_meta_pen"].error == "missing_mp4;missing_nova_annotation" and got["gone"].error == "missing_source"
    put("flat.mp4")
    put("flat_pred.mp4")
    got = {r.video_id: r for r in catalog.inference_inventory(readers.listing(spark, str(tmp_path)), str(tmp_path)).collect()}
    assert "inference__flat" in got and "inference__s1__bad" in got and "inference__flat_pred" not in got
    assert "inference__s1__batch__S1_F_meta_lie-up_x__a" in got and got["inference__s1__bad"].subject_id == "unknown"


def test_inventory_round_trips(spark, tmp_path):
    df = readers.typed(spark.createDataFrame([("s", "v", None, True, 5)], "source string, video_id string, error string, hard_negative_eligible boolean, video_size long"), INVENTORY)
    sinks.inventory_csv(df, str(tmp_path / "csv"))
    sinks.inventory_jsonl(df, str(tmp_path / "json"))
    for back in (readers.inventory_csv(spark, str(tmp_path / "csv")), readers.inventory_jsonl(spark, str(tmp_path / "json"))):
        assert back.schema == INVENTORY and back.collect() == df.collect()


def test_npz_records(spark, tmp_path):
    x = np.arange(128 * 3, dtype=np.float32).reshape(128, 3)
    np.savez_compressed(tmp_path / "a.npz", features=x, labels=np.array([1, 2, 14]), valid_mask=np.ones(3), video_id=np.asarray("a"), fps=np.float32(15), schema_version=np.asarray("v"), feature_names=np.asarray(feature_names()))
    got = readers.sequences_npz(spark, str(tmp_path), "v").orderBy("frame").collect()
    assert [r.label for r in got] == [1, 2, 14] and got[1].features == x[:, 1].tolist() and got[0].scene == "unknown"
    h = readers.sequence_headers_npz(spark, str(tmp_path)).first()
    assert (h.video_id, h.num_frames, h.labelled, h.valid_ratio, h.polarity) == ("a", 3, True, 1.0, "unknown")
    with pytest.raises(Exception, match="schema v, not w"):
        readers.sequences_npz(spark, str(tmp_path), "w").collect()
    np.savez_compressed(tmp_path / "t.track", landmarks=np.zeros((2, 21, 3)), tracking_quality=np.ones(2), valid_mask=np.array([1.0, 0.0]), source_fps=np.float32(30), metadata_json=np.asarray(json.dumps({"physical_hand": "left"})))
    got = readers.tracks_npz(spark, str(tmp_path), "*.track.npz").orderBy("frame").collect()
    assert [r.hand_side for r in got] == [-1, 0]


def test_text_sinks(spark, tmp_path, timeline_of):
    f = timeline_of({"a": [14, 14, 3, 3, 3, 14], "b": [14]})
    i = timeline.frames_to_intervals(f, 15.0)
    sinks.annotation_text(i, str(tmp_path / "notes"))
    text = next((tmp_path / "notes" / "video_id=a").glob("part-*")).read_text()
    assert text == "0.1335;0.3332;3;1.0000;\n"
    back = readers.annotations(spark, str(tmp_path / "notes"), "part-*").select(F.lit("a").alias("video_id"), "line_no", "start_sec", "end_sec", "label")
    v = spark.createDataFrame([("a", 6, 15.0)], "video_id string, num_frames int, fps double")
    assert [r[1] for r in rows(timeline.intervals_to_frames(v, back), "frame", "label")] == [14, 14, 3, 3, 3, 14]
    sinks.srt(i, str(tmp_path / "srt"), [f"n{k}" for k in range(15)])
    assert next((tmp_path / "srt" / "video_id=a").glob("part-*")).read_text() == "1\n00:00:00,133 --> 00:00:00,333\nn3\n"
    sinks.frames_csv(f, str(tmp_path / "frames"), 15.0, [f"n{k}" for k in range(15)])
    assert next((tmp_path / "frames" / "video_id=a").glob("part-*")).read_text().splitlines()[1] == "0,0.0000,14,n14,14,n14,1"
    sinks.segments_json(f, str(tmp_path / "segments"), 15.0)
    assert {r.video_id: len(r.segments) for r in spark.read.json(str(tmp_path / "segments")).collect()} == {"a": 3, "b": 1}


def test_quality_report_is_worst_first(spark, tmp_path):
    df = spark.createDataFrame([("good", 0.95), ("worst", 0.31), ("mid", 0.62), ("none", None)], "video_id string, detection_rate double")
    sinks.quality_csv(df.coalesce(1), str(tmp_path / "q"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "q").glob("part-*")))
    assert [x for x in text.splitlines() if not x.startswith("video_id")] == ["none,", "worst,0.3100", "mid,0.6200", "good,0.9500"]


def test_manifest(spark, tmp_path):
    r = spark.createDataFrame([("a", "train"), ("b", "validation"), ("c", "test")], "video_id string, split string")
    path = sinks.manifest_json(r, str(tmp_path / "m.json"), seed=1)
    assert rows(readers.manifest(spark, path), "split", "path") == [("test", "c"), ("train", "a"), ("validation", "b")]
    assert [x.path for x in readers.inputs(spark, [], path, "train").collect()] == ["a"] and [x.path for x in readers.inputs(spark, ["x"]).collect()] == ["x"]
    with pytest.raises(ValueError, match="test"):
        sinks.manifest_json(r.where("split <> 'test'"), path)


def test_configs_and_summaries(spark, tmp_path):
    p = tmp_path / "c.json"
    p.write_text('{"a": {"b": 1}, "c": 2}')
    assert readers.config(str(p), "a")["c"] == 2
    with pytest.raises(ValueError, match="c"):
        readers.config(str(p), "c")
    counts = catalog.inventory_summary(spark.createDataFrame([("ok", "s", None), ("error", "s", "x;y")], "status string, source string, error string"), ("status", "source"))
    assert json.loads(open(sinks.summary_json(counts, str(tmp_path / "s.json"))).read()) == {"error": {"x": 1, "y": 1}, "source": {"s": 2}, "status": {"error": 1, "ok": 1}}


def test_latest_run(spark):
    files = spark.createDataFrame([("/o/0101/0101_1/predictions.json",), ("/o/0102/0102_3/predictions.json",), ("/o/0103/x/other.json",)], "path string")
    assert readers.latest_run(files).first().run == "/o/0102/0102_3"


def test_assembly_of_mirrored_hands(spark):
    rng = np.random.default_rng(2)
    out = []
    for i in range(60):
        p = rng.random(63).tolist()
        ok = float(rng.random() > 0.1)
        left = [1 - x if k % 3 == 0 else x for k, x in enumerate(p)]
        out += [("r", i, p, ok, 0.9, 1), ("l", i, left, ok, 0.9, -1)]
    t = spark.createDataFrame(out, "video_id string, frame int, landmarks array<double>, valid double, quality double, side int")
    i = spark.createDataFrame([("r", 1, 0.5, 1.0, 3), ("l", 1, 0.5, 1.0, 3)], "video_id string, line_no int, start_sec double, end_sec double, label int")
    frames, report = assemble.assembled(t, i, 30.0)
    got = {(r.video_id, r.frame): r for r in frames.collect()}
    assert len(got) == 60 and all(got["l", k].coords == pytest.approx(got["r", k].coords, abs=1e-4) and got["l", k].label == got["r", k].label for k in range(30))
    assert {r.video_id: r.hand_side for r in report.collect()} == {"r": "physical_right", "l": "physical_left_mirrored"}


def test_mock_sequences_do_not_depend_on_partitions(spark):
    a = readers.mock_frames(spark, 4, 60)
    assert a.count() == 240 and rows(a, "video_id", "frame", "label") == rows(readers.mock_frames(spark, 4, 60).repartition(3), "video_id", "frame", "label")


def test_streamed_filter_and_runs_equal_the_batch_ones(spark, tmp_path, timeline_of):
    f = timeline_of({"a": [14, 14, 1, 1, 14, 2], "b": [3, 3, 14, 14, 14, 14]}).withColumn("value", F.col("frame") * 1.5)
    source = str(tmp_path / "in")
    for cut in ("frame < 3", "frame >= 3"):
        f.where(cut).coalesce(1).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema(f.schema).option("maxFilesPerTrigger", 1).parquet(source)
    for n, (out, want) in enumerate(((filters.one_euro_stream(stream(), 15.0), smoothing.one_euro(f, 15.0, "value")), (filters.runs_stream(stream()), timeline.segments(f).drop("seg_id")))):
        q = out.writeStream.format("memory").queryName(f"s{n}").outputMode("append").option("checkpointLocation", str(tmp_path / f"c{n}")).start()
        q.processAllAvailable()
        q.stop()
        got = spark.table(f"s{n}")
        if n:
            want = want.where("seg_end < 6")  # the last runs are still open
            assert rows(got, "video_id", "label", "seg_start", "seg_end") == rows(want, "video_id", "label", "seg_start", "seg_end")
        else:
            assert [x[2] for x in rows(got, "video_id", "frame", "value")] == pytest.approx([x[2] for x in rows(want, "video_id", "frame", "value")], abs=1e-5)


def test_numbers_as_text_round_as_c_does(spark):
    values = [0.00015, 0.00005, 1.00005, 2.5, -0.00015, 123456.78905]
    df = spark.createDataFrame([(x,) for x in [*values, None, float("nan")]], "x double")
    assert [r.t for r in df.select(scalars.fixed(F.col("x")).alias("t")).collect()] == [*(f"{x:.4f}" for x in values), None, None]


def test_subtitles_show_the_confidence(spark):
    df = spark.createDataFrame([("a", 0.0, 1.5, 3, 0.875)], "video_id string, start_sec double, end_sec double, label int, confidence double")
    assert timeline.srt_blocks(df, confidence=True).first().block.endswith("\nclass 3 (0.88)") and timeline.srt_blocks(df).first().block.endswith("\nclass 3")


def test_written_records_are_read_again(spark, tmp_path):
    x = np.random.default_rng(2).random((5, 128)).astype("float32")
    rows_ = [("s/1", "v1", 15.0, x.tolist(), [1.0, 0.0, 1.0, 1.0, 1.0], [14, 14, 2, 2, 14], "S1"), ("s/1", "v2", 15.0, x.tolist(), [1.0] * 5, None, "S2")]
    df = spark.createDataFrame(rows_, "source string, video_id string, fps double, features array<array<float>>, valid array<float>, labels array<int>, subject_id string")
    assert df.count() == 2
    out = sinks.sequences_npz(df.withColumn("source", F.lit("one")), str(tmp_path), "v3").collect()
    assert sorted(r.file for r in out) == [str(tmp_path / "one" / "v1.npz"), str(tmp_path / "one" / "v2.npz")]
    back = readers.sequences_npz(spark, str(tmp_path), "v3").orderBy("video_id", "frame").collect()
    assert [r.label for r in back] == [14, 14, 2, 2, 14] + [None] * 5 and np.allclose([r.features for r in back[:5]], x) and back[0].subject_id == "S1"
    found = readers.sequence_sources(readers.listing(spark, str(tmp_path)), str(tmp_path))
    assert {r.source for r in found.collect()} == {"one"} and found.count() == 2
    alone = readers.sequence_sources(readers.listing(spark, str(tmp_path / "one")), str(tmp_path / "one"))
    assert {r.source for r in alone.collect()} == {"one"} and alone.count() == 2


def test_runs_and_their_predictions(spark, tmp_path, timeline_of):
    f = timeline_of({"a": [14, 1, 1], "b": [2]})
    for run in ("20250101", "20250301", "20250201"):
        (tmp_path / run).mkdir()
        sinks.arrays(f, str(tmp_path / run / "prediction.parquet"))
        (tmp_path / run / "predictions.json").write_text("{}")
    (tmp_path / "20250401").mkdir()
    got = {r.video_id: r.prediction for r in readers.predictions(spark, readers.listing(spark, str(tmp_path))).collect()}
    assert got == {"a": [14, 1, 1], "b": [2]}
    with pytest.raises(FileNotFoundError):
        readers.predictions(spark, readers.listing(spark, str(tmp_path / "20250401")))


def test_what_is_missing_is_said(spark, tmp_path):
    gone = readers.listing(spark, str(tmp_path / "none")).collect()
    assert len(gone) == 1 and gone[0].error.startswith("io_error:") and readers.io_error("a;b") == "io_error:a,b"
    (tmp_path / "x.npz").write_bytes(b"x")
    files = readers.listing(spark, str(tmp_path))
    records = spark.createDataFrame([("train", str(tmp_path / "x.npz"))], "split string, path string")
    assert readers.checked_manifest(records, files).count() == 1
    with pytest.raises(Exception, match="file is missing"):
        readers.checked_manifest(records.withColumn("path", F.lit("/no/such.npz")), files).collect()
    d = spark.createDataFrame([("a", 0.9, "bad header"), ("b", 0.9, None), ("c", 0.1, None)], "video_id string, detection_rate double, load_error string").withColumn("polarity", F.lit("positive")).withColumns({c: F.lit(None).cast("double") for c in ("min_class_detection_rate", "core_detection_rate", "min_class_core_detection_rate")})
    assert {r.video_id: r.status for r in audit.quality_gate(d, 0.5, 0.5).collect()} == {"a": "load_failed", "b": "passed", "c": "rejected"}


def test_settings_refuse_what_makes_no_sense():
    assert config.ManifestConfig.from_dict({"sources": ["a", "b"], "seed": 3}).sources == ("a", "b")
    for bad in ({"physical_hand": "both"}, {"allow_opposite_hand_fallback": True}, {"max_hands": 0}, {"other": 1}):
        with pytest.raises(ValueError):
            config.TrackConfig.from_dict(bad)


def test_paths_of_records(spark):
    df = spark.createDataFrame([("a/b", "v\\1", "f0")], "s string, v string, f string")
    r = df.select(catalog.sequence_path("/root/", F.col("s"), F.col("v")).alias("a"), catalog.track_path("/root", F.col("s"), F.col("v"), F.col("f")).alias("b")).first()
    assert tuple(r) == ("/root/a_b/v_1.npz", "/root/f0/a_b/v_1.track.npz")


def test_reports_as_json(spark, tmp_path):
    import json
    from pathlib import Path

    per = spark.createDataFrame([("b", 0.5), ("a", 1.0)], "video_id string, frame_accuracy double")
    sinks.metrics_json(per, evaluate.mean_metrics(per), str(tmp_path / "m"))
    text = [json.loads(line) for p in Path(tmp_path / "m").glob("*.json") for line in p.read_text().splitlines()]
    assert text == [{"mean": {"frame_accuracy": 0.75}, "videos": [{"video_id": "a", "frame_accuracy": 1.0}, {"video_id": "b", "frame_accuracy": 0.5}]}]
    g = lambda rows_, kinds: spark.createDataFrame(rows_, kinds)
    sinks.stats_json(g([("x", 2)], "grp string, videos int"), g([("x", 3, 1)], "grp string, class_id int, segments int"), g([("x", "sit", 2)], "grp string, scene string, videos int"), g([("x", 0, 4)], "grp string, p05 int, p50 int"), str(tmp_path / "s"))
    text = [json.loads(line) for p in Path(tmp_path / "s").glob("*.json") for line in p.read_text().splitlines()]
    assert text == [{"grp": "x", "videos": 2, "classes": [{"class_id": 3, "segments": 1}], "scenes": [{"scene": "sit", "videos": 2}], "gaps": {"p05": 0, "p50": 4}}]


def test_whole_assembly_equals_a_plain_one(spark):
    """The tracks of one video, step by step in numpy."""
    rng = np.random.default_rng(6)
    n = 24
    points, valid, side = rng.normal(size=(n, 63)), rng.random(n) > 0.2, np.where(np.arange(n) % 5 == 0, -1, 1)
    tracks = spark.createDataFrame([("a", i, points[i].tolist(), float(valid[i]), 0.5, int(side[i])) for i in range(n)], "video_id string, frame int, landmarks array<double>, valid double, quality double, side int")
    got = assemble.source_tracks(tracks, 30.0, assemble.Assembly()).orderBy("frame").collect()
    value = speed = None
    for i in range(n):
        p = points[i].reshape(21, 3).copy()
        if side[i] == -1:
            p[:, 0] *= -1
        palm = max(np.mean([np.linalg.norm(p[k] - p[0]) for k in (5, 9, 13, 17)]), 1e-3)
        x = np.append((p - p[0]).ravel(), palm)
        if valid[i]:
            if value is None:
                value, speed = x, np.zeros(64)
            else:
                a = lambda c: 1 / (1 + 30 / (2 * np.pi * c))
                speed = a(1.0) * (x - value) * 30 + (1 - a(1.0)) * speed
                b = a(1.0 + 0.007 * np.abs(speed))
                value = b * x + (1 - b) * value
        want = np.append(np.zeros(63), 1.0) if value is None else value
        assert np.allclose(got[i].coords, want[:63], atol=1e-5) and got[i].palm == pytest.approx(want[63], abs=1e-5)
