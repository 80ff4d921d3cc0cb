"""Evaluation of predicted timelines: frames, edit distance, matched segments, and reports."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import f1, iou, ratio
from ..schema import BACKGROUND, NUM_CLASSES
from .timeline import action_spans, segments


def class_dimension(spark, names: list[str] | None = None) -> DataFrame:
    """(class_id, class_name) of all classes: a table of fixed size."""
    names = names or [f"class_{i}" for i in range(NUM_CLASSES)]
    return spark.range(len(names)).select(F.col("id").cast("int").alias("class_id"), F.get(F.array(*(F.lit(n) for n in names)), F.col("id").cast("int")).alias("class_name"))


def aligned(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """(video_id, frame, pred, label); a frame that only one side has is an error."""
    both = predictions.select("video_id", "frame", F.col("pred"), F.lit(1).alias("_p")).join(truth.select("video_id", "frame", "label", F.lit(1).alias("_t")), ["video_id", "frame"], "full")
    checked = F.when(F.col("_p").isNull() | F.col("_t").isNull(), F.raise_error(F.concat(F.lit("prediction and truth differ in length: "), F.col("video_id").cast("string")))).otherwise(F.col("pred"))
    return both.select("video_id", "frame", checked.cast("int").alias("pred"), "label")


def frame_accuracy(frames: DataFrame) -> DataFrame:
    """(video_id, frame_accuracy)."""
    return frames.groupBy("video_id").agg(F.avg((F.col("pred") == F.col("label")).cast("double")).alias("frame_accuracy"))


def _run_text(frames: DataFrame, label: str, name: str) -> DataFrame:
    letters = F.transform(F.sort_array(F.collect_list(F.struct("seg_start", "label"))), lambda x: F.char(x["label"] + 97))
    return segments(frames, label).groupBy("video_id").agg(F.array_join(letters, "").alias(name))


def edit_score(frames: DataFrame) -> DataFrame:
    """(video_id, edit): 100 times one less the edit distance of the run labels, background included, over the longer list."""
    both = _run_text(frames, "pred", "_p").join(_run_text(frames, "label", "_t"), "video_id")
    longer = F.greatest(F.length("_p"), F.length("_t"))
    return both.select("video_id", F.when(longer == 0, 100.0).otherwise((1 - F.levenshtein("_p", "_t") / longer) * 100).alias("edit"))


def match_counts_unique(frames: DataFrame, threshold: float) -> DataFrame:
    """(video_id, class_id, tp, fp, fn) for thresholds of 0.5 and more, where a segment has one possible partner at most, so an equi-join with an overlap condition finds it."""
    if threshold < 0.5:
        raise ValueError("below 0.5 the order of matching counts: use match_counts()")
    p = action_spans(segments(frames, "pred")).select("video_id", F.col("label").alias("class_id"), F.col("seg_start").alias("p0"), F.col("seg_end").alias("p1"))
    t = action_spans(segments(frames, "label")).select("video_id", F.col("label").alias("class_id"), F.col("seg_start").alias("t0"), F.col("seg_end").alias("t1"))
    same = (F.col("p.video_id") == F.col("t.video_id")) & (F.col("p.class_id") == F.col("t.class_id"))
    overlap = (F.col("p0") < F.col("t1")) & (F.col("t0") < F.col("p1")) & (iou(F.col("p0"), F.col("p1"), F.col("t0"), F.col("t1")) >= threshold)
    # a prediction keeps its row with or without a partner, so one join serves both counts
    tried = p.alias("p").join(t.alias("t"), same & overlap, "left").select("p.video_id", "p.class_id", F.col("t0").isNotNull().alias("hit"))
    own = tried.groupBy("video_id", "class_id").agg(F.count("*").alias("np"), F.count_if("hit").alias("tp"))
    both = own.join(t.groupBy("video_id", "class_id").agg(F.count("*").alias("nt")), ["video_id", "class_id"], "full").na.fill(0, ["np", "nt", "tp"])
    return both.select("video_id", "class_id", "tp", (F.col("np") - F.col("tp")).alias("fp"), (F.col("nt") - F.col("tp")).alias("fn"))


def _greedy(pred: list[tuple[int, int, int]], truth: list[tuple[int, int, int]], threshold: float) -> dict[int, list[int]]:
    """[tp, fp, fn] by class. Both lists are in time order, so the truths that a prediction overlaps are next to each other."""
    counts: dict[int, list[int]] = {}
    free = {c: [s for s in truth if s[0] == c] for c in {s[0] for s in truth}}
    begin = dict.fromkeys(free, 0)
    used: set[tuple[int, int, int]] = set()
    for p in pred:
        own, best, best_iou = free.get(p[0], []), None, 0.0
        i = begin.get(p[0], 0)
        while i < len(own) and own[i][2] <= p[1]:
            i += 1
        begin[p[0]] = i
        while i < len(own) and own[i][1] < p[2]:
            t = own[i]
            both = min(p[2], t[2]) - max(p[1], t[1])
            x = both / ((p[2] - p[1]) + (t[2] - t[1]) - both)
            if t not in used and x >= threshold and x > best_iou:
                best, best_iou = t, x
            i += 1
        c = counts.setdefault(p[0], [0, 0, 0])
        if best:
            used.add(best)
            c[0] += 1
        else:
            c[1] += 1
    for t in truth:
        if t not in used:
            counts.setdefault(t[0], [0, 0, 0])[2] += 1
    return counts


def match_counts(frames: DataFrame, thresholds: list[float]) -> DataFrame:
    """(video_id, threshold, class_id, tp, fp, fn): predictions in time order take the free truth of their class that overlaps most.

    Each choice depends on those before, so a video's run lists, which are much
    shorter than its frames, go through one Arrow function.
    """
    lists = lambda label, name: action_spans(segments(frames, label)).groupBy("video_id").agg(F.sort_array(F.collect_list(F.struct("seg_start", "seg_end", "label"))).alias(name))
    both = lists("pred", "p").join(lists("label", "t"), "video_id", "full")
    kind = both.schema["video_id"].dataType.simpleString()

    def match(batches):
        for pdf in batches:
            out = []
            for v, p, t in zip(pdf["video_id"], pdf["p"], pdf["t"], strict=True):
                of = lambda x: [(int(r["label"]), int(r["seg_start"]), int(r["seg_end"])) for r in x] if x is not None else []
                for threshold in thresholds:
                    out += [(v, threshold, c, *n) for c, n in _greedy(of(p), of(t), threshold).items()]
            yield pd.DataFrame(out, columns=["video_id", "threshold", "class_id", "tp", "fp", "fn"])

    return both.mapInPandas(match, f"video_id {kind}, threshold double, class_id int, tp long, fp long, fn long")


def f1_by_video(counts: DataFrame) -> DataFrame:
    """(video_id, threshold, f1) over all classes of a video."""
    s = [F.sum(c).alias(c) for c in ("tp", "fp", "fn")]
    return counts.groupBy("video_id", "threshold").agg(*s).select("video_id", "threshold", f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"))


def video_metrics(frames: DataFrame, thresholds: tuple[float, ...] = (0.1, 0.25, 0.5)) -> DataFrame:
    """(video_id, frame_accuracy, edit, f1_10, ...): all metrics of each video; a video without any action scores 1."""
    wide = f1_by_video(match_counts(frames, list(thresholds))).groupBy("video_id").pivot("threshold", list(thresholds)).agg(F.first("f1"))
    names = {str(t): f"f1_{round(t * 100)}" for t in thresholds}
    wide = wide.withColumnsRenamed(names)
    out = frame_accuracy(frames).join(edit_score(frames), "video_id").join(wide, "video_id", "left")
    return out.na.fill(1.0, list(names.values()))


def mean_metrics(per_video: DataFrame) -> DataFrame:
    """The unweighted mean of each metric over videos."""
    return per_video.agg(*(F.avg(c).alias(c) for c in per_video.columns if c != "video_id"))


def confusion(frames: DataFrame, classes: int = NUM_CLASSES) -> DataFrame:
    """(true_id, pred_id, n) of all pairs of classes; labels out of range are left out."""
    ids = frames.sparkSession.range(classes).select(F.col("id").cast("int").alias("true_id"), F.explode(F.sequence(F.lit(0), F.lit(classes - 1))).alias("pred_id"))
    inside = F.col("label").between(0, classes - 1) & F.col("pred").between(0, classes - 1)
    n = frames.where(inside).groupBy(F.col("label").alias("true_id"), F.col("pred").alias("pred_id")).agg(F.count("*").alias("n"))
    return ids.join(n, ["true_id", "pred_id"], "left").na.fill(0, ["n"])


def frame_report(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and the class most often taken for it, by class; nulls for a class that does not occur."""
    own = F.when(F.col("true_id") == F.col("pred_id"), F.col("n")).otherwise(0)
    other = F.when((F.col("true_id") != F.col("pred_id")) & (F.col("n") > 0), F.struct("n", (-F.col("pred_id")).alias("neg")))
    row = matrix.groupBy(F.col("true_id").alias("class_id")).agg(F.sum("n").alias("support"), F.sum(own).alias("tp"), F.max(other).alias("top"))
    column = matrix.groupBy(F.col("pred_id").alias("class_id")).agg(F.sum("n").alias("predicted"))
    both = row.join(column, "class_id")
    present = (F.col("support") > 0) | (F.col("predicted") > 0)
    tp, fp, fn = F.col("tp"), F.col("predicted") - F.col("tp"), F.col("support") - F.col("tp")
    rate = lambda whole: F.when(present, F.coalesce(ratio(tp, whole), F.lit(0.0)))
    return both.select("class_id", F.col("support").alias("support_frames"), F.col("predicted").alias("predicted_frames"), rate(F.col("predicted")).alias("frame_precision"), rate(F.col("support")).alias("frame_recall"), F.when(present, f1(tp, fp, fn)).alias("frame_f1"), F.coalesce(-F.col("top.neg"), F.lit(-1)).cast("int").alias("top_confusion"), F.coalesce("top.n", F.lit(0)).alias("top_confusion_frames"))


def segment_report(counts: DataFrame, *by: str) -> DataFrame:
    """Segment precision, recall and F1 by class (and by)."""
    s = counts.groupBy(*by, "class_id").agg(*(F.sum(c).alias(c) for c in ("tp", "fp", "fn")))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return s.select(*by, "class_id", (tp + fn).alias("support_segments"), (tp + fp).alias("predicted_segments"), "tp", "fp", "fn", zero(ratio(tp, tp + fp)).alias("segment_precision"), zero(ratio(tp, tp + fn)).alias("segment_recall"), f1(tp, fp, fn).alias("segment_f1"))


def negative_metrics(frames: DataFrame, fps: float) -> DataFrame:
    """(video_id, false_positive_frame_rate, predicted_action_segments, false_actions_per_minute) of videos without actions."""
    runs = segments(frames, "pred").groupBy("video_id").agg(F.count_if(F.col("label") != BACKGROUND).alias("predicted_action_segments"), F.sum(F.when(F.col("label") != BACKGROUND, F.col("seg_end") - F.col("seg_start")).otherwise(0)).alias("_bad"), F.max("seg_end").alias("_n"))
    return runs.select("video_id", ratio(F.col("_bad"), F.col("_n")).alias("false_positive_frame_rate"), "predicted_action_segments", F.coalesce(ratio(F.col("predicted_action_segments"), F.col("_n") / F.lit(fps * 60.0)), F.lit(0.0)).alias("false_actions_per_minute"))


def false_actions_by_class(frames: DataFrame) -> DataFrame:
    """(video_id, class_id, n) of the actions predicted in videos without any."""
    return action_spans(segments(frames, "pred")).groupBy("video_id", F.col("label").alias("class_id")).agg(F.count("*").alias("n"))


def group_key(value: Column) -> Column:
    """The text of a metadata value, 'unknown' for none or a blank one."""
    return F.coalesce(F.nullif(F.trim(value.cast("string")), F.lit("")), F.lit("unknown"))


def grouped_metrics(per_video: DataFrame, fields: list[str], metrics: list[str]) -> DataFrame:
    """(field, value, video_count, *metrics): means over the videos of each value of each field, of those that have the metric. One pass over grouping sets."""
    per_video = per_video.withColumns({f: group_key(F.col(f)) for f in fields})
    grouped = per_video.groupingSets([[F.col(f)] for f in fields], *(F.col(f) for f in fields)).agg(F.count("*").alias("video_count"), *(F.avg(m).alias(m) for m in metrics), F.grouping_id().alias("_g"))
    n = len(fields)
    bit = lambda i: F.shiftright(F.col("_g"), n - 1 - i).bitwiseAND(1) == 0
    field = F.coalesce(*(F.when(bit(i), F.lit(f)) for i, f in enumerate(fields)))
    value = F.coalesce(*(F.when(bit(i), F.col(f)) for i, f in enumerate(fields)))
    return grouped.select(field.alias("field"), value.alias("value"), "video_count", *metrics)


def coverage(frames: DataFrame, names: list[str] | None = None) -> DataFrame:
    """(class_id, gt_frames, gt_segments, videos) of all classes."""
    f = frames.groupBy(F.col("label").alias("class_id")).agg(F.count("*").alias("gt_frames"), F.countDistinct("video_id").alias("videos"))
    s = segments(frames).groupBy(F.col("label").alias("class_id")).agg(F.count("*").alias("gt_segments"))
    out = class_dimension(frames.sparkSession, names).join(f, "class_id", "left").join(s, "class_id", "left")
    return out.select("class_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gt_frames", "gt_segments", "videos")))


def micro_macro(counts: DataFrame) -> DataFrame:
    """(threshold, micro_f1, macro_class_f1): F1 of the summed counts, and the mean F1 of the classes that occur."""
    per_class = counts.groupBy("threshold", "class_id").agg(*(F.sum(c).alias(c) for c in ("tp", "fp", "fn")))
    own = f1(F.col("tp"), F.col("fp"), F.col("fn"))
    out = per_class.groupBy("threshold").agg(F.avg(own).alias("macro_class_f1"), *(F.sum(c).alias(c) for c in ("tp", "fp", "fn")))
    return out.select("threshold", f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("micro_f1"), "macro_class_f1")


def per_class_report(frames: DataFrame, counts: DataFrame, thresholds: list[float]) -> DataFrame:
    """frame_report() and coverage() by class, with segment metrics for each threshold as columns."""
    wide = segment_report(counts, "threshold").groupBy("class_id").pivot("threshold", thresholds).agg(F.first("segment_f1").alias("f1"), F.first("segment_precision").alias("precision"), F.first("segment_recall").alias("recall"), F.first("predicted_segments").alias("predicted"))
    wide = wide.withColumnsRenamed({f"{t}_{m}": f"segment_{m}_{round(t * 100)}" for t in thresholds for m in ("f1", "precision", "recall", "predicted")})
    return frame_report(confusion(frames)).join(coverage(frames).drop("gt_frames"), "class_id").join(wide, "class_id", "left")


def ranking(report: DataFrame, metric: str = "frame_f1", support: str = "support_frames") -> DataFrame:
    """The classes that occur, worst first."""
    return report.where(F.col(support) > 0).orderBy(metric, "class_id")


def run_report(per_video: DataFrame, low: float) -> DataFrame:
    """One row from (video_id, detection_rate, raw_accuracy, filtered_accuracy, changed): how many videos are of low quality, and the mean accuracies of the changed ones."""
    changed = F.col("changed") > 0
    return per_video.agg(F.count("*").alias("videos"), F.count_if(F.coalesce("detection_rate", F.lit(0.0)) < low).alias("low_quality"), F.count_if(changed).alias("changed"), F.avg(F.when(changed, F.col("raw_accuracy"))).alias("raw_accuracy"), F.avg(F.when(changed, F.col("filtered_accuracy"))).alias("filtered_accuracy"))
