"""The evaluation of whole videos: window scores, fusion, post-processing and all metrics in one plan."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate, scoring, windows
from ..operators.postprocess import Postprocess, postprocess


@dataclass(frozen=True)
class Evaluation:
    """How videos are cut into windows and what is done to predictions before they are measured."""

    size: int = 60
    stride: int = 12
    fps: float = 15.0
    thresholds: tuple[float, ...] = (0.1, 0.25, 0.5)
    filters: Postprocess = field(default_factory=Postprocess)


def scored(frames: DataFrame, scorer: scoring.Scorer, config: Evaluation, features: str = "features") -> DataFrame:
    """(video_id, frame, class_id, score): a model's scores of frames (video_id, frame, features, label, valid), fused over their windows."""
    cut = windows.sliding_windows(windows.lengths(frames), config.size, config.stride)
    padded = windows.padded(cut, frames, config.size, [features]).join(cut, ["video_id", "win_start"])
    return windows.fused(scoring.scored_windows(padded, scorer, config.size, features=features), config.size)


def predicted(scores: DataFrame, config: Evaluation) -> tuple[DataFrame, list[DataFrame]]:
    """The frames (video_id, frame, pred, logits) after all filters, and the report of each filter."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("class_id", "score"))), lambda x: x["score"])
    frames = windows.fused_labels(scores).join(scores.groupBy("video_id", "frame").agg(ordered.alias("logits")), ["video_id", "frame"])
    return postprocess(frames, config.filters, config.fps)


def full_videos(scores: DataFrame, truth: DataFrame, config: Evaluation) -> DataFrame:
    """(video_id, frame_accuracy, edit, f1_...): the metrics of each video; a frame that only one side has, or that has no label, is an error."""
    frames, _ = predicted(scores, config)
    both = evaluate.aligned(frames, truth)
    label = F.when(F.col("label").isNull(), F.raise_error(F.concat(F.lit("no label: "), F.col("video_id").cast("string"))).cast("int")).otherwise(F.col("label"))
    return evaluate.video_metrics(both.withColumn("label", label), config.thresholds)
