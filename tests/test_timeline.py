import numpy as np
import pytest
from pyspark.sql import functions as F

from tempoloom.functions import scalars as S
from tempoloom.operators import audit, landmarks, resample, smoothing, stats, timeline, windows


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_runs_of_labels(timeline_of):
    s = timeline.segments(timeline_of({"a": [14, 14, 1, 1, 1, 14, 2, 2, 14]}))
    assert rows(s, "seg_id", "label", "seg_start", "seg_end")[1] == (1, 1, 2, 5)
    touching = timeline.action_spans(timeline.segments(timeline_of({"a": [1, 1, 14, 2, 2, 2]})))
    assert rows(touching, "label", "seg_start", "seg_end") == [(1, 0, 2), (2, 3, 6)]
    assert timeline.action_spans(timeline.segments(timeline_of({"a": [14, 14]}))).count() == 0


def test_runs_of_nulls_and_an_empty_timeline(timeline_of):
    s = timeline.segments(timeline_of({"a": [None, None, 1]}, {"a": [0, 0, 0]}))
    assert sorted(map(tuple, s.select("seg_start", "seg_end", "label").collect()), key=str) == [(0, 2, None), (2, 3, 1)]
    assert timeline.segments(timeline_of({"a": [1]}).where("false")).count() == 0


def test_runs_go_back_to_frames(spark, timeline_of):
    rng = np.random.default_rng(0)
    f = timeline_of({f"v{i}": rng.choice([0, 1, 14], size=int(rng.integers(1, 60))).tolist() for i in range(20)})
    s = timeline.segments(f)
    back = s.select("video_id", F.explode(F.sequence("seg_start", F.col("seg_end") - 1)).alias("frame"), "label")
    assert rows(back, "video_id", "frame", "label") == rows(f, "video_id", "frame", "label")


@pytest.mark.parametrize("fps", [15.0, 25.0, 29.97, 30.0, 60.0])
def test_written_intervals_come_back_on_the_same_frames(spark, timeline_of, fps):
    rng = np.random.default_rng(int(fps))
    f = timeline_of({f"v{i}": np.repeat(rng.choice([0, 1, 2, 14], size=12), rng.integers(1, 9, size=12)).tolist() for i in range(8)})
    i = timeline.annotation_times(timeline.frames_to_intervals(f, fps, "label")).withColumn("line_no", F.lit(1))
    back = timeline.intervals_to_frames(windows.lengths(f).withColumn("fps", F.lit(fps)), i)
    assert rows(back, "video_id", "frame", "label") == rows(f, "video_id", "frame", "label")


def test_intervals_to_frames(spark):
    i = spark.createDataFrame([("a", 1, 0.0, 0.2, 10), ("a", 2, 1.0, 1.4, 14), ("a", 3, 2.0, 2.5, 12), ("a", 4, 9.0, 9.5, 3)], "video_id string, line_no int, start_sec double, end_sec double, label int")
    v = spark.createDataFrame([("a", 30, 10.0)], "video_id string, num_frames int, fps double")
    got = [r[1] for r in rows(timeline.intervals_to_frames(v, i), "frame", "label")]
    assert got == [10] * 2 + [14] * 18 + [12] * 5 + [14] * 5


def test_subtitle_times(spark):
    df = spark.createDataFrame([(0.0,), (1.5,), (3723.456,), (-1.0,)], "s double").select(S.timestamp_text(F.col("s")))
    assert [r[0] for r in df.collect()] == ["00:00:00,000", "00:00:01,500", "01:02:03,456", "00:00:00,000"]


def test_positions_in_the_longest_gap(timeline_of):
    valid = [0 if 10 <= i < 14 or 40 <= i < 70 else 1 for i in range(100)]
    got = [r[0] for r in rows(timeline.diagnostic_positions(timeline_of({"a": [14] * 100}, valid={"a": valid})), "frame")]
    assert sum(40 <= x < 70 for x in got) == 4 and len(got) == 6 and {40, 69} <= set(got)


def test_forward_fill_before_and_after_the_first_valid_frame(spark):
    f = spark.createDataFrame([("a", 0, 5.0, 0), ("a", 1, 6.0, 1), ("a", 2, 7.0, 0), ("a", 3, 8.0, 1)], "video_id string, frame int, value double, valid int")
    assert rows(timeline.forward_fill(f, {"value": F.lit(0.0)}), "frame", "value") == [(0, 0.0), (1, 6.0), (2, 6.0), (3, 8.0)]


def test_class_stats(timeline_of):
    """Against numpy's nearest rank over runs of random lengths."""
    rng = np.random.default_rng(17)
    lengths = rng.integers(1, 60, size=37)
    f = timeline_of({f"v{i}": [3] * int(n) + [14] * 2 for i, n in enumerate(lengths)})
    r = stats.class_run_stats(timeline.segments(f), window=31, fps=12.5).where("class_id = 3").first()
    assert (r.segments, r.frames_total, r.max_frames) == (37, lengths.sum(), lengths.max()) and r.mean_frames == pytest.approx(lengths.mean())
    assert [r.p50_frames, r.p90_frames, r.p99_frames] == [int(np.percentile(lengths, p, method="inverted_cdf")) for p in (50, 90, 99)]
    assert r.over_window == (lengths > 31).sum() and r.over_window_share == pytest.approx((lengths > 31).mean()) and r.p50_sec == pytest.approx(r.p50_frames / 12.5)


def test_gaps_stay_within_a_video(timeline_of):
    g = stats.action_gaps(timeline.segments(timeline_of({"p": [14, 4, 14, 14, 4, 5, 14], "q": [6, 14], "r": [14, 14, 7, 14, 14, 14, 14, 8]})))
    assert sorted(x for (x,) in rows(g, "gap")) == [0, 2, 4]


def test_missing_classes(timeline_of):
    got = rows(stats.missing_classes(timeline.segments(timeline_of({"a": [0, 2, 14]}))), "class_id")
    assert [x[0] for x in got] == [1, *range(3, 14)]


def test_buckets_equal_their_definition(spark):
    for source, target in ((30.0, 15.0), (29.97, 15.0), (120.0, 15.0), (25.0, 24.0)):
        ratio, got = source / target, {}
        for f, b in spark.range(400).select(F.col("id"), resample.bucket(F.col("id"), source, target)).collect():
            got.setdefault(b, []).append(f)
        at, i = 0, 0
        while at < 400:
            start, end = int(np.floor(i * ratio)), int(np.floor((i + 1) * ratio))
            assert got[i] == list(range(start, min(400, max(end, start + 1))))
            at, i = end, i + 1
    with pytest.raises(ValueError):
        resample.bucket(F.col("id"), 10.0, 15.0)


def test_aggregated_bucket(spark):
    f = spark.createDataFrame([("a", 0, [2.0], 1.0, 0.8, 1), ("a", 1, [2.0], 3.0, 1.0, 1)], "video_id string, frame int, coords array<double>, palm double, quality double, valid int")
    r = resample.tracks_aggregated(f, 30.0, 15.0, 1).first()
    assert r.coords == [1.0] and r.quality == pytest.approx(0.9) and r.valid == 1


def test_trimmed_mean(spark):
    f = spark.createDataFrame([("a", i, float(x)) for i, x in enumerate([100, 1, 2, 3, -50])], "video_id string, frame int, value double")
    assert resample.downsampled(f, 75.0, 15.0, {"m": resample.robust_mean(F.col("value"))}).first().m == 2.0


def test_one_euro_equals_its_recurrence(spark):
    rng = np.random.default_rng(3)
    x, ok = rng.normal(size=40), rng.random(40) > 0.2
    f = spark.createDataFrame([("a", i, float(v), int(o)) for i, (v, o) in enumerate(zip(x, ok, strict=True))], "video_id string, frame int, value double, valid int")
    got = [r[1] for r in rows(smoothing.one_euro(f, 15.0, "value"), "frame", "value")]
    dt, a = 1 / 15, lambda c: 1 / (1 + 1 / (2 * np.pi * c) / (1 / 15))
    value, speed, want = None, 0.0, []
    for v, o in zip(x, ok, strict=True):
        if o:
            if value is None:
                value = v
            else:
                speed = a(1.0) * (v - value) / dt + (1 - a(1.0)) * speed
                value = a(1.0 + 0.007 * abs(speed)) * v + (1 - a(1.0 + 0.007 * abs(speed))) * value
        want.append(value or 0.0)
    assert got == pytest.approx(want, abs=1e-5)


def test_videos_are_filtered_in_step(spark, monkeypatch):
    """Many videos of different lengths and channels at once, in small batches, equal each of them alone."""
    monkeypatch.setattr(smoothing, "TOGETHER", 50)
    rng = np.random.default_rng(4)
    data = {f"v{i}": (rng.normal(size=(int(n), 3)).tolist(), (rng.random(int(n)) > 0.3).astype(int).tolist()) for i, n in enumerate(rng.integers(1, 90, 25))}
    f = spark.createDataFrame([(v, i, None if i == 4 else x, ok) for v, (xs, oks) in data.items() for i, (x, ok) in enumerate(zip(xs, oks, strict=True))], "video_id string, frame int, coords array<double>, valid int")
    got = {(r.video_id, r.frame): r.coords for r in smoothing.one_euro(f.repartition(3), 15.0).collect()}
    assert len(got) == sum(len(x) for x, _ in data.values())
    for v, (xs, oks) in data.items():
        value, speed = np.full(3, np.nan), np.zeros(3)
        for i, (x, ok) in enumerate(zip(xs, oks, strict=True)):
            if ok and i != 4:
                value, speed = smoothing.follow(value, speed, np.array(x), 1 / 15, 1.0, 0.007, 1.0)
            assert got[v, i] == pytest.approx(np.where(np.isnan(value), 0, value).tolist(), abs=1e-6)


def test_a_mirrored_left_hand_is_a_right_one(spark):
    p = np.random.default_rng(1).random(63).tolist()
    left = [1 - x if i % 3 == 0 else x for i, x in enumerate(p)]
    df = spark.createDataFrame([(p, left)], "r array<double>, l array<double>")
    a, b = df.select(landmarks.frame_coords(F.col("r"), F.lit(1), 1.5), landmarks.frame_coords(F.col("l"), F.lit(-1), 1.5)).first()
    assert a == pytest.approx(b, abs=1e-9) and a[:3] == [0, 0, 0]


def test_hand_choice(spark):
    h = spark.createDataFrame([("a", 0, 0, 1, 0.6), ("a", 0, 1, -1, 0.9), ("a", 1, 0, 1, 0.99), ("a", 1, 1, -1, 0.7), ("a", 2, 0, 1, 0.8), ("a", 3, 0, -1, 0.95), ("a", 3, 1, 1, 0.6), ("a", 4, 0, 1, 0.1)], "video_id string, frame int, hand_no int, side int, score double")
    assert rows(landmarks.auto_hand(h, 0.5), "frame", "side") == [(0, -1), (1, -1), (2, 1), (3, 1)]
    assert rows(landmarks.strict_hand(h, 1, 0.5), "frame", "hand_no") == [(0, 0), (1, 0), (2, 0), (3, 1)]


def test_audit_rates(timeline_of):
    f = timeline_of({"a": [14, 0, 0, 1, 1, 14]}, valid={"a": [0, 1, 0, 1, 1, 0]})
    assert audit.detection_rates(f).first().detection_rate == 0.75
    assert tuple(audit.worst_class(audit.class_rates(f)).first())[1:] == (0, 0.5)
    assert timeline.longest_missing(f, 15.0).first().longest_missing_frames == 1


def test_core_of_an_action(timeline_of):
    f = timeline_of({"a": [14, 3, 14, 4, 4, 4, 14]})
    assert [r[1] for r in rows(audit.with_core(f, 0.45), "frame", "core")] == [False, True, False, False, True, False, False]
    g = timeline_of({"a": [2 if 10 <= i < 30 else 14 for i in range(40)]}, valid={"a": [int(15 <= i < 25) for i in range(40)]})
    assert tuple(audit.detection_rates(g, 0.25).first())[1:] == (0.5, 1.0)


def test_few_jumps_are_not_reliable(spark):
    f = spark.createDataFrame([("a", i, [float(i)], 1.0, int(i < 4)) for i in range(40)], "video_id string, frame int, coords array<double>, palm double, valid int")
    assert tuple(audit.jump_rate(f).first())[1:] == (0.0, False)


def test_a_missing_polarity_is_not_an_unknown_one(spark):
    r = spark.createDataFrame([(1, None, 0.9), (2, "unknown", 0.9), (3, "positive", 0.1)], "id int, polarity string, detection_rate double")
    for c in ("min_class_detection_rate", "core_detection_rate", "min_class_core_detection_rate"):
        r = r.withColumn(c, F.lit(None).cast("double"))
    assert rows(audit.quality_gate(r, 0.5, 0.5), "id", "quality_passed") == [(1, True), (2, False), (3, False)]
