"""Filters over predicted runs, in a fixed order, with a report of what each stage changed."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import masked_argmax, softmax
from ..schema import BACKGROUND
from .timeline import segments, with_runs


def with_allowed_classes(frames: DataFrame, allowed: list[int], logits: str = "logits") -> DataFrame:
    """frames with pred: the best of the allowed classes."""
    return frames.withColumn("pred", masked_argmax(F.col(logits), allowed))


def filter_confidence(frames: DataFrame, threshold: float, probability: Column, label: str = "pred") -> DataFrame:
    """Runs of actions whose mean probability of their class is below the threshold become background.

    A run is added up from its last frame to its first, on any partitioning: a
    mean that is the threshold but for its last bit depends on the order.
    """
    runs = with_runs(frames.withColumn("_p", probability), label, "_run")
    run = Window.partitionBy("video_id", "_run").orderBy(F.desc("frame")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    mean = F.avg("_p").over(run)
    low = (F.col(label) != BACKGROUND) & (mean < threshold)
    return runs.withColumn(label, F.when(low, F.lit(BACKGROUND)).otherwise(F.col(label))).drop("_p", "_run")


def minimal_frames(seconds: float, fps: float) -> int:
    """Seconds in frames, halves to the even number, one at least."""
    return max(1, round(seconds * fps))


def filter_duration_runs(runs: DataFrame, least: int) -> DataFrame:
    """runs with new_label: an action shorter than least frames gets the label of its neighbours if both have the same action, else the background.

    The neighbours are those of the input, so short runs side by side do not
    decide about each other.
    """
    order = Window.partitionBy("video_id").orderBy("seg_start")
    before, after = F.lag("label").over(order), F.lead("label").over(order)
    short = (F.col("label") != BACKGROUND) & (F.col("seg_end") - F.col("seg_start") < least)
    same = before.isNotNull() & (before == after) & (before != BACKGROUND)
    if least <= 1:
        return runs.withColumn("new_label", F.col("label"))
    return runs.withColumn("new_label", F.when(short & same, before).when(short, F.lit(BACKGROUND)).otherwise(F.col("label")))


def filter_duration(frames: DataFrame, least: int, label: str = "pred") -> DataFrame:
    """The same on frames, by windows alone: a run's neighbours stand before its first and after its last frame, so one exchange on video_id serves all."""
    if least <= 1:
        return frames
    runs = with_runs(frames, label, "_run")
    order = Window.partitionBy("video_id").orderBy("frame")
    run = Window.partitionBy("video_id", "_run").orderBy("frame").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sides = runs.withColumn("_lag", F.lag(label).over(order)).withColumn("_lead", F.lead(label).over(order))
    sides = sides.withColumn("_before", F.first("_lag").over(run)).withColumn("_after", F.last("_lead").over(run)).withColumn("_n", F.count("*").over(run))
    short = (F.col(label) != BACKGROUND) & (F.col("_n") < least)
    same = F.col("_before").isNotNull() & (F.col("_before") == F.col("_after")) & (F.col("_before") != BACKGROUND)
    new = F.when(short & same, F.col("_before")).when(short, F.lit(BACKGROUND)).otherwise(F.col(label))
    return sides.withColumn(label, new).drop("_run", "_lag", "_lead", "_before", "_after", "_n")


@dataclass(frozen=True)
class Postprocess:
    """What is done to predictions; stages without a setting are left out."""

    allowed: list[int] = field(default_factory=list)
    min_confidence: float | None = None
    min_seconds: float | None = None


def stage_report(both: DataFrame, stage: str, label: str = "pred", old: str = "_old") -> DataFrame:
    """(video_id, stage, changed_frames, actions_before, actions_after) of frames that have the labels before and after a stage, in one pass."""
    order = Window.partitionBy("video_id").orderBy("frame")
    begins = lambda c: (F.col(c) != BACKGROUND) & ~F.coalesce(F.lag(c).over(order) == F.col(c), F.lit(False))
    rows = both.select("video_id", (~F.col(label).eqNullSafe(F.col(old))).alias("_changed"), begins(old).alias("_before"), begins(label).alias("_after"))
    return rows.groupBy("video_id").agg(F.count_if("_changed").alias("changed_frames"), F.count_if("_before").alias("actions_before"), F.count_if("_after").alias("actions_after")).select("video_id", F.lit(stage).alias("stage"), "changed_frames", "actions_before", "actions_after")


def postprocess(frames: DataFrame, config: Postprocess, fps: float, probability: Column | None = None, label: str = "pred", logits: str = "logits") -> tuple[DataFrame, list[DataFrame]]:
    """The frames after all stages (classes, confidence, duration), and a report of each stage that ran.

    probability: that of the predicted class; the softmax of the logits if it isn't given.
    """
    reports = []

    def ran(stage: str, after: DataFrame) -> DataFrame:
        # the stages keep other columns, so a frame brings its label from before along
        reports.append(stage_report(after, stage, label))
        return after.drop("_old")

    was = lambda: frames.withColumn("_old", F.col(label) if label in frames.columns else F.lit(None).cast("int"))
    if config.allowed:
        frames = ran("classes", with_allowed_classes(was(), config.allowed, logits))
    if config.min_confidence is not None and config.min_confidence > 0:
        own = probability if probability is not None else F.get(softmax(F.col(logits)), F.col(label))
        frames = ran("confidence", filter_confidence(was(), config.min_confidence, own, label))
    if config.min_seconds is not None:
        frames = ran("duration", filter_duration(was(), minimal_frames(config.min_seconds, fps), label))
    return frames, reports
