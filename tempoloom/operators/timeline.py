"""Runs of a label timeline, filled gaps, and intervals to and from frames.

A timeline has one row for each (video_id, frame), frames counted from 0
without gaps. All operators of one timeline share one exchange on video_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import fixed, linspace_int, quantised, timestamp_text
from ..schema import BACKGROUND


def _order():
    return Window.partitionBy("video_id").orderBy("frame")


def with_runs(frames: DataFrame, label: str = "label", run: str = "seg_id") -> DataFrame:
    """frames with the number of the maximal run of equal labels that a frame is in; nulls are equal."""
    before = F.lag(label).over(_order())
    begins = F.lag("frame").over(_order()).isNull() | ~before.eqNullSafe(F.col(label))
    return frames.withColumn("_begins", begins.cast("int")).withColumn(run, (F.sum("_begins").over(_order()) - 1).cast("int")).drop("_begins")


def segments(frames: DataFrame, label: str = "label", *more: Column) -> DataFrame:
    """(video_id, seg_id, label, seg_start, seg_end, *more): the runs, as half-open frame ranges; more: aggregates over a run's frames."""
    runs = with_runs(frames, label)
    return runs.groupBy("video_id", "seg_id").agg(F.min(label).cast("int").alias("label"), F.min("frame").cast("int").alias("seg_start"), (F.max("frame") + 1).cast("int").alias("seg_end"), *more)


def action_spans(runs: DataFrame, background: int = BACKGROUND) -> DataFrame:
    """The runs of actions; touching runs of different actions stay apart."""
    return runs.where(F.col("label") != background)


def forward_fill(frames: DataFrame, values: dict[str, Column], valid: str = "valid") -> DataFrame:
    """frames with each of values taken from the last valid frame, and its default before the first one."""
    last = _order().rowsBetween(Window.unboundedPreceding, 0)
    fill = {c: F.coalesce(F.last(F.when(F.col(valid) > 0.5, F.col(c)), ignorenulls=True).over(last), default) for c, default in values.items()}
    return frames.withColumns(fill)


def missing_runs(frames: DataFrame, valid: str = "valid") -> DataFrame:
    """The runs of frames without a valid hand."""
    state = frames.withColumn("_state", (F.coalesce(F.col(valid), F.lit(0)) > 0.5).cast("int"))
    return segments(state, "_state").where("label = 0").drop("label")


def longest_missing(frames: DataFrame, fps: float, valid: str = "valid") -> DataFrame:
    """(video_id, longest_missing_frames, longest_missing_seconds), 0 for a video without gaps."""
    state = frames.withColumn("_state", (F.coalesce(F.col(valid), F.lit(0)) > 0.5).cast("int"))
    longest = F.max(F.when(F.col("label") == 0, F.col("seg_end") - F.col("seg_start")).otherwise(0)).cast("int")
    return segments(state, "_state").groupBy("video_id").agg(longest.alias("longest_missing_frames")).withColumn("longest_missing_seconds", F.col("longest_missing_frames") / F.lit(float(fps)))


def diagnostic_positions(frames: DataFrame, lost: int = 4, found: int = 2, valid: str = "valid") -> DataFrame:
    """(video_id, frame): frames spread over the first of the longest gaps, and over the valid frames."""
    gaps = missing_runs(frames, valid).withColumn("n", F.col("seg_end") - F.col("seg_start"))
    gap = gaps.groupBy("video_id").agg(F.max(F.struct("n", (-F.col("seg_start")).alias("neg"))).alias("g")).select("video_id", (-F.col("g.neg")).alias("low"), (F.col("g.n") - F.col("g.neg") - 1).alias("high"))
    steps = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i")
    of_gap = gap.select("video_id", "low", "high", steps(lost)).select("video_id", linspace_int(F.col("low"), F.col("high"), F.col("i"), lost).alias("frame"))
    rank = Window.partitionBy("video_id").orderBy("frame")
    good = frames.where(F.col(valid) > 0.5).select("video_id", "frame", (F.row_number().over(rank) - 1).alias("at"), F.count("*").over(Window.partitionBy("video_id")).alias("n"))
    picks = good.select("video_id", "frame", "at", steps(found), "n").where(F.col("at") == linspace_int(F.lit(0), F.col("n") - 1, F.col("i"), found)).select("video_id", "frame")
    return of_gap.union(picks).distinct()


def intervals_to_frames(videos: DataFrame, intervals: DataFrame, background: int = BACKGROUND) -> DataFrame:
    """(video_id, frame, label) of each frame of videos (video_id, num_frames, fps): the label of the last interval that covers it, by line_no.

    Each interval becomes the frames it covers and meets the timeline by
    equality, so no range join is needed.
    """
    at = intervals.join(videos, "video_id").select("video_id", "line_no", "label", "num_frames", F.greatest(F.lit(0), F.floor(F.col("start_sec") * F.col("fps"))).alias("low"), F.ceil(F.col("end_sec") * F.col("fps")).alias("high"))
    at = at.withColumn("high", F.least(F.col("num_frames"), F.greatest("low", "high"))).where("low < high")
    covered = at.select("video_id", "line_no", "label", F.explode(F.sequence(F.col("low").cast("int"), (F.col("high") - 1).cast("int"))).alias("frame"))
    last = covered.groupBy("video_id", "frame").agg(F.max_by("label", "line_no").alias("label"))
    all_frames = videos.where("num_frames > 0").select("video_id", F.explode(F.sequence(F.lit(0), F.col("num_frames").cast("int") - 1)).alias("frame"))
    return all_frames.join(last, ["video_id", "frame"], "left").withColumn("label", F.coalesce("label", F.lit(background)))


def frames_to_intervals(frames: DataFrame, fps: float, label: str = "pred", probability: Column | None = None, background: int = BACKGROUND) -> DataFrame:
    """(video_id, start_sec, end_sec, label, confidence) of the runs of actions; the confidence is the mean probability of the run's class, 1 without."""
    confidence = F.avg(probability if probability is not None else F.lit(1.0)).alias("confidence")
    return action_spans(segments(frames, label, confidence), background).select("video_id", (F.col("seg_start") / F.lit(float(fps))).alias("start_sec"), (F.col("seg_end") / F.lit(float(fps))).alias("end_sec"), "label", "confidence")


def annotation_times(intervals: DataFrame) -> DataFrame:
    """intervals with the times as they are written to an annotation."""
    start, end = quantised(F.col("start_sec"), F.col("end_sec"))
    return intervals.select("*", start.alias("_s"), end.alias("_e")).withColumns({"start_sec": F.col("_s"), "end_sec": F.col("_e")}).drop("_s", "_e")


def srt_blocks(intervals: DataFrame, names: list[str] | None = None, confidence: bool = False) -> DataFrame:
    """(video_id, block_no, block): the subtitle block of each interval, numbered from 1 by start; confidence: with that of the interval behind the name."""
    name = F.get(F.array(*(F.lit(n) for n in names)), F.col("label")) if names else F.concat(F.lit("class "), F.col("label").cast("string"))
    if confidence:
        name = F.concat(name, F.lit(" ("), fixed(F.col("confidence"), 2), F.lit(")"))
    number = F.row_number().over(Window.partitionBy("video_id").orderBy("start_sec", "end_sec", "label"))
    head = intervals.withColumn("block_no", number.cast("int"))
    block = F.concat(F.col("block_no").cast("string"), F.lit("\n"), timestamp_text(F.col("start_sec")), F.lit(" --> "), timestamp_text(F.col("end_sec")), F.lit("\n"), name)
    return head.select("video_id", "block_no", block.alias("block"))


def srt_text(blocks: DataFrame) -> DataFrame:
    """(video_id, srt): each video's blocks as one text."""
    ordered = F.sort_array(F.collect_list(F.struct("block_no", "block")))
    return blocks.groupBy("video_id").agg(F.concat(F.array_join(F.transform(ordered, lambda x: x["block"]), "\n\n"), F.lit("\n")).alias("srt"))
