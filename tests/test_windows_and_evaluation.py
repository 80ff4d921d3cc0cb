import numpy as np
import pytest
from pyspark.sql import functions as F

from tempoloom.functions import scalars as S
from tempoloom.operators import catalog, evaluate, postprocess, scoring, timeline, windows

from .test_timeline import rows


def test_window_starts(spark):
    df = spark.createDataFrame([(100,), (60,), (10,), (0,)], "n int").select(windows.window_starts(F.col("n"), 60, 12))
    assert [r[0] for r in df.collect()] == [[0, 12, 24, 36, 40], [0], [0], []]


def test_padding(timeline_of):
    f = timeline_of({"a": [1] * 10})
    p = windows.padded(windows.sliding_windows(windows.lengths(f), 16, 4), f, 16, [])
    assert [r[1] for r in rows(p, "pos", "label")] == [1] * 10 + [-100] * 6
    assert [r[1] for r in rows(p, "pos", "valid")] == [1.0] * 10 + [0.0] * 6


def test_background_windows(timeline_of):
    f = timeline_of({"a": [14] * 4 + [0] * 4 + [14] * 4})
    w = windows.labelled_windows(f, 4, 4)
    assert rows(w, "win_start", "is_background") == [(0, True), (4, False), (8, True)]
    assert windows.labelled_windows(f, 4, 4, keep_background=-1.0).count() == 1


def test_hard_negatives(spark):
    c = spark.createDataFrame([(f"n{i % 3}", i, i + 4) for i in range(60)], "video_id string, win_start int, win_end int")
    assert windows.hard_negatives(c, 10, 0.2, 50).count() == 2
    assert windows.hard_negatives(c, 0, 0.2, 50).count() == 1
    assert windows.hard_negatives(c, 1000, 1.0, 5).count() == 15
    assert windows.hard_negatives(c, 10, 0.2, 50).exceptAll(windows.hard_negatives(c.repartition(7), 10, 0.2, 50)).count() == 0


def test_action_windows_show_the_action(timeline_of):
    f = timeline_of({"a": [14] * 30 + [3] * 5 + [14] * 30, "b": [2] * 40})
    for r in windows.action_windows(f, 16, 4, 6).collect():
        assert (r.win_start <= 30 and r.win_end >= 35) if r.video_id == "a" else (r.win_start, r.win_end) == (12, 28)


def test_fusion_of_constant_scores_is_constant(spark, timeline_of):
    f = timeline_of({"a": [0] * 30}).withColumn("logits", F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0)))
    s = windows.fused(windows.window_scores(windows.sliding_windows(windows.lengths(f), 12, 5), f), 12)
    assert all(r.score == pytest.approx([1, 3, 3][r.class_id]) for r in s.collect()) and s.count() == 90


def test_masked_argmax(spark):
    x = [0.0] * 15
    x[0], x[9] = 3.0, 2.0
    y = [0.0] * 15
    y[14] = 9.0
    df = spark.createDataFrame([(x,), (y,)], "l array<double>")
    ids = S.resolve_class_ids([9], [f"c{i}" for i in range(15)])
    assert [r[0] for r in df.select(S.masked_argmax(F.col("l"), ids)).collect()] == [9, 14]
    assert [r[0] for r in df.select(S.masked_argmax(F.col("l"), [])).collect()] == [0, 14]
    with pytest.raises(ValueError):
        S.resolve_class_ids([True], ["a"])


def test_confidence_filter(timeline_of):
    f = timeline_of({"a": [0] * 3 + [14] + [1] * 2}).withColumn("p", F.when(F.col("label") == 0, 0.95).otherwise(0.42))
    assert [r[1] for r in rows(postprocess.filter_confidence(f, 0.7, F.col("p")), "frame", "pred")] == [0, 0, 0, 14, 14, 14]


def test_a_mean_at_the_threshold_is_added_up_from_the_last_frame(timeline_of):
    """The mean of 0.7, 24.2 and 47.1 over 60 is 0.4 from the last to the first, and its last bit less in the other order."""
    values = [0.7, 24.2, 47.1]
    for own, want in ((values, [1] * 3), (values[::-1], [14] * 3)):
        f = timeline_of({"a": [1] * 3}).withColumn("p", F.get(F.array(*(F.lit(v) for v in own)), "frame") / 60.0)
        for one in (f, f.orderBy(F.desc("frame"))):
            assert [r[1] for r in rows(postprocess.filter_confidence(one, 0.4, F.col("p")), "frame", "pred")] == want


@pytest.mark.parametrize(
    ("labels", "want"),
    [([0] * 12 + [14] * 5 + [1] * 2, [0] * 12 + [14] * 7), ([12] * 8 + [3] * 2 + [12] * 8, [12] * 18), ([0] * 6 + [14] * 2 + [0] * 6, [0] * 6 + [14] * 2 + [0] * 6), ([5] * 6 + [1, 1, 2, 2] + [5] * 6, [5] * 6 + [14] * 4 + [5] * 6)],
)
def test_duration_filter(timeline_of, labels, want):
    assert [r[1] for r in rows(postprocess.filter_duration(timeline_of({"a": labels}), 5), "frame", "pred")] == want


def test_halves_of_a_frame_go_to_the_even_number():
    assert postprocess.minimal_frames(0.5, 15.0) == 8 and postprocess.minimal_frames(0.0, 15.0) == 1


def test_perfect_and_shifted_predictions(timeline_of):
    t = {"a": [14] * 5 + [1] * 5 + [14] * 5}
    r = evaluate.video_metrics(timeline_of(t)).first()
    assert (r.frame_accuracy, r.edit, r.f1_10, r.f1_50) == (1.0, 100.0, 1.0, 1.0)
    r = evaluate.video_metrics(timeline_of(t, {"a": [14] * 9 + [1] * 5 + [14]})).first()
    assert r.f1_10 == 1.0 and r.f1_50 == 0.0 and r.edit == 100.0


def test_greedy_matching_equals_a_plain_one(timeline_of):
    rng = np.random.default_rng(5)
    runs = lambda: np.repeat(rng.choice([0, 1, 14], 12), rng.integers(1, 7, 12))
    videos = {}
    for i in range(40):
        a, b = runs(), runs()
        n = min(len(a), len(b))
        videos[f"v{i}"] = a[:n].tolist(), b[:n].tolist()
    f = timeline_of({v: t for v, (t, _) in videos.items()}, {v: p for v, (_, p) in videos.items()})
    got = {(r.video_id, r.threshold, r.class_id): (r.tp, r.fp, r.fn) for r in evaluate.match_counts(f, [0.1, 0.25, 0.5]).collect()}

    def spans(x):
        cuts = [0, *(i for i in range(1, len(x)) if x[i] != x[i - 1]), len(x)]
        return [(x[a], a, b) for a, b in zip(cuts, cuts[1:], strict=False) if x[a] != 14]

    want = {}
    for v, (t, p) in videos.items():
        for threshold in (0.1, 0.25, 0.5):
            truth, taken, counts = spans(t), set(), {}
            for c, a, b in spans(p):
                scores = [(max(0, min(b, y) - max(a, x)) / (max(b, y) - min(a, x)) if min(b, y) > max(a, x) else 0.0, -i) for i, (k, x, y) in enumerate(truth) if k == c and i not in taken]
                best = max((s for s in scores if s[0] >= threshold and s[0] > 0), default=None)
                counts.setdefault(c, [0, 0, 0])[0 if best else 1] += 1
                if best:
                    taken.add(-best[1])
            for i, (c, _, _) in enumerate(truth):
                if i not in taken:
                    counts.setdefault(c, [0, 0, 0])[2] += 1
            want |= {(v, threshold, c): tuple(n) for c, n in counts.items()}
    assert got == want
    unique = {(r.video_id, 0.5, r.class_id): (r.tp, r.fp, r.fn) for r in evaluate.match_counts_unique(f, 0.5).collect()}
    assert unique == {k: x for k, x in want.items() if k[1] == 0.5}


def test_a_prediction_without_truth_is_an_error(timeline_of):
    a = timeline_of({"a": [1, 1]})
    with pytest.raises(Exception, match="differ in length"):
        evaluate.aligned(a, timeline_of({"a": [1, 1, 1]})).collect()


def test_negative_videos(timeline_of):
    r = evaluate.negative_metrics(timeline_of({"a": [14] * 6}, {"a": [14, 1, 1, 14, 2, 14]}), 1.0).first()
    assert tuple(r)[1:] == (0.5, 2, 20.0)


def test_grouped_means_leave_out_missing_metrics(spark):
    df = spark.createDataFrame([("a", "x", "s", "p", 0.5, None), ("b", "x", "s", "n", 1.0, 0.2)], "video_id string, source string, scene string, polarity string, acc double, neg double")
    got = {(r.field, r.value): (r.video_count, r.acc, r.neg) for r in evaluate.grouped_metrics(df, ["source", "scene", "polarity"], ["acc", "neg"]).collect()}
    assert got == {("source", "x"): (2, 0.75, 0.2), ("scene", "s"): (2, 0.75, 0.2), ("polarity", "p"): (1, 0.5, None), ("polarity", "n"): (1, 1.0, 0.2)}


def test_class_weights(spark):
    f = spark.range(100010).select(F.lit("a").alias("video_id"), F.when(F.col("id") < 100000, 0).otherwise(1).alias("label"))
    w = {r.class_id: r.weight for r in catalog.class_weights(f, 50.0).collect()}
    assert w[1] / w[0] == pytest.approx(50) and w[2] == w[1]
    none = catalog.class_weights(f.where("false"))
    assert {r.weight for r in none.collect()} == {1.0}


def test_scenes_and_names(spark):
    t = catalog.taxonomy_frame(spark, {"exact": {"lie-up": {"polarity": "positive", "category": "posture"}, "pen": "negative"}, "aliases": {"biro": "pen"}})
    got = catalog.resolved_scenes(spark.createDataFrame([("  LIE_UP  ",), ("stand-alarm-strong",), ("biro",)], "scene_raw string"), t)
    assert sorted(map(tuple, got.collect())) == [("  LIE_UP  ", "lie-up", "positive", "posture", False), ("biro", "pen", "negative", "confounder", True), ("stand-alarm-strong", None, None, "unknown", False)]
    n = spark.createDataFrame([("S1_F_meta_sit_extra",), ("S1_F__sit",), ("S1_F",), ("x_y_l",)], "n string").select("n", *(c.alias(k) for k, c in catalog.name_parts(F.col("n")).items()), catalog.hand_side(F.col("n")).alias("side"))
    assert {r.n: (r.subject_id, r.scene_raw, r.name_error, r.side) for r in n.collect()} == {"S1_F_meta_sit_extra": ("S1", "sit", None, None), "S1_F__sit": (None, None, "invalid_name", None), "S1_F": (None, None, "invalid_name", None), "x_y_l": (None, None, "invalid_name", "L")}


def test_splits(spark):
    keys = spark.range(200).select(F.col("id").cast("string").alias("subject_id"))
    a = catalog.hashed_splits(keys.union(keys), "subject_id", (0.7, 0.15, 0.15))
    assert {r.split: r["count"] for r in a.groupBy("split").count().collect()} == {"train": 140, "validation": 30, "test": 30}
    assert a.exceptAll(catalog.hashed_splits(keys.repartition(9), "subject_id", (0.7, 0.15, 0.15))).count() == 0
    with pytest.raises(ValueError, match="add up"):
        catalog.hashed_splits(keys, "subject_id", (0.7, 0.2, 0.2))
    with pytest.raises(Exception, match="three values"):
        catalog.hashed_splits(keys.limit(2), "subject_id", (0.7, 0.15, 0.15)).collect()


def test_whole_groups_are_split(spark):
    sizes = {f"g{i}": 1 + (7 * i) % 40 for i in range(60)}
    members = spark.createDataFrame([(g, i) for g, n in sizes.items() for i in range(n)], "g string, i int").repartition(7)
    of = {r.g: r.split for r in catalog.grouped_splits(members, "g", (0.6, 0.2, 0.2), 4).collect()}
    share = {s: sum(sizes[g] for g in of if of[g] == s) / sum(sizes.values()) for s in ("train", "validation", "test")}
    assert of.keys() == sizes.keys() and abs(share["train"] - 0.6) < 0.06 and abs(share["test"] - 0.2) < 0.06
    few = spark.createDataFrame([("a", 1)] * 90 + [("b", 2), ("c", 3)], "g string, i int")
    assert sorted(r.split for r in catalog.grouped_splits(few, "g", (0.6, 0.2, 0.2)).collect()) == ["test", "train", "validation"]
    with pytest.raises(Exception, match="three values"):
        catalog.grouped_splits(few.where("g <> 'a'"), "g", (0.6, 0.2, 0.2)).collect()


def test_a_registry_has_to_know_all(spark):
    registry = spark.createDataFrame([("a", "train"), ("b", "test")], "subject_id string, split string")
    rows_ = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "subject_id string")
    assert rows(catalog.registered_splits(rows_, "subject_id", registry), "subject_id", "split") == [("a", "train"), ("b", "test")]
    more = rows_.union(spark.createDataFrame([("c",)], "subject_id string"))
    with pytest.raises(Exception, match="lacks subject_id c"):
        catalog.registered_splits(more, "subject_id", registry).collect()
    records = more.selectExpr("subject_id", "coalesce(subject_id, 'x') AS video_id", "true AS quality_passed")
    with pytest.raises(Exception, match="no split for subject c"):
        catalog.manifest_records(records, registry, records.limit(0)).collect()


def test_hard_negatives_are_the_least_of_all(spark):
    c = spark.createDataFrame([(f"v{i % 30}", i, i + 4) for i in range(600)], "video_id string, win_start int, win_end int")
    out = windows.hard_negatives(c, 100, 0.25, 3)
    assert out.columns == c.columns and out.count() == 25 and out.exceptAll(windows.hard_negatives(c.repartition(9), 100, 0.25, 3)).count() == 0
    assert max(r["count"] for r in out.groupBy("video_id").count().collect()) <= 3 and windows.hard_negatives(c, 0, 0.25, 3).count() == 1 and windows.hard_negatives(c, 100, 0.0, 3).count() == 0


def test_leaks_and_fingerprints(spark):
    r = spark.createDataFrame([("a", "train"), ("a", "train"), ("b", "test")], "video_id string, split string")
    assert rows(catalog.leaks(r), "video_id", "n") == [("a", 2)]
    p = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("abc", None), ("abc", "")], "x string, y string")
    assert p.select(catalog.row_fingerprint(F.col("x"), F.col("y"))).distinct().count() == 4
    assert catalog.fingerprint({"b": 1, "a": 2, "run": 3}, ("run",)) == catalog.fingerprint({"a": 2, "b": 1})


def test_network_is_the_same_in_any_batch(spark):
    rng = np.random.default_rng(0)
    w = lambda *s: rng.normal(size=s).astype(np.float32)
    weights = {"PG.conv_1x1_in.weight": w(4, 6, 1), "PG.conv_1x1_in.bias": w(4), "PG.conv_out.weight": w(3, 4, 1), "PG.conv_out.bias": w(3)}
    for i in range(2):
        for name, shape in ((f"PG.conv_dilated_1.{i}", (4, 4, 3)), (f"PG.conv_dilated_2.{i}", (4, 4, 3)), (f"PG.conv_fusion.{i}", (4, 8, 1))):
            weights |= {f"{name}.weight": w(*shape), f"{name}.bias": w(shape[0])}
    for name, shape in (("Rs.0.conv_1x1", (4, 3, 1)), ("Rs.0.layers.0.conv_dilated", (4, 4, 3)), ("Rs.0.layers.0.conv_1x1", (4, 4, 1)), ("Rs.0.conv_out", (3, 4, 1))):
        weights |= {f"{name}.weight": w(*shape), f"{name}.bias": w(shape[0])}
    scoring.check_weights(weights, 6, 3)
    with pytest.raises(ValueError):
        scoring.check_weights(weights, 7, 3)
    model = scoring.build("ms_tcn2", weights=weights)
    f = spark.createDataFrame([("a", i, rng.normal(size=6).tolist(), 0, 1) for i in range(25)], "video_id string, frame int, features array<double>, label int, valid int")
    win = windows.sliding_windows(windows.lengths(f), 8, 3)
    padded = windows.padded(win, f, 8, ["features"]).join(win, ["video_id", "win_start"])
    a, b = ({(r.win_start, r.pos, r.class_id): r.logit for r in scoring.scored_windows(padded, model, 8, n).collect()} for n in (1, 256))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-4) for k in a) and len(a) == 7 * 8 * 3
    assert windows.fused_labels(windows.fused(scoring.scored_windows(padded, model, 8), 8)).count() == 25


def test_diagnostics_of_runs(timeline_of):
    strips = timeline.missing_runs(timeline_of({"a": [0] * 5}, valid={"a": [1, 0, 0, 1, 0]}))
    assert rows(strips, "seg_start", "seg_end") == [(1, 3), (4, 5)]
