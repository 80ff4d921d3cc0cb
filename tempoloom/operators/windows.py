"""Windows of a fixed number of frames, window sampling, and the fusion of overlapping scores.

Random choices depend on hashed keys, not on a generator's state, so they are
the same however the rows are partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import hamming, hash_unit
from ..schema import BACKGROUND, IGNORE
from .ranks import ranked
from .timeline import action_spans, segments


def window_starts(frames: Column, size: int, stride: int) -> Column:
    """0, stride, ... and the last possible start; an empty array for no frames."""
    last = F.greatest(frames - size, F.lit(0)).cast("int")
    return F.when(frames > 0, F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.lit(stride)), F.array(last)))).otherwise(F.array().cast("array<int>"))


def lengths(frames: DataFrame) -> DataFrame:
    return frames.groupBy("video_id").agg((F.max("frame") + 1).cast("int").alias("num_frames"))


def sliding_windows(videos: DataFrame, size: int, stride: int) -> DataFrame:
    """(video_id, win_start, win_end) over videos (video_id, num_frames)."""
    starts = videos.select("video_id", "num_frames", F.explode(window_starts(F.col("num_frames"), size, stride)).alias("win_start"))
    return starts.select("video_id", "win_start", F.least(F.col("win_start") + size, F.col("num_frames")).cast("int").alias("win_end"))


def labelled_windows(frames: DataFrame, size: int, stride: int, keep_background: float = 1.0, background_role: str = "background", seed: int = 0, label: str = "label") -> DataFrame:
    """(video_id, win_start, win_end, is_background, window_role): the windows, those of only background kept with a probability."""
    counted = frames.select("video_id", "frame", F.when(F.col(label) == BACKGROUND, 0).otherwise(1).alias("_a"))
    running = F.sum("_a").over(Window.partitionBy("video_id").orderBy("frame"))
    # actions before each frame: a window is background if the count does not change over it
    before = counted.select("video_id", (F.col("frame") + 1).alias("_at"), running.alias("_n"))
    w = sliding_windows(lengths(frames), size, stride)
    ends = w.join(before.withColumnsRenamed({"_at": "win_end", "_n": "_end"}), ["video_id", "win_end"], "left")
    both = ends.join(before.withColumnsRenamed({"_at": "win_start", "_n": "_begin"}), ["video_id", "win_start"], "left")
    flagged = both.withColumn("is_background", F.coalesce("_end", F.lit(0)) == F.coalesce("_begin", F.lit(0)))
    kept = flagged.where(~F.col("is_background") | (hash_unit(F.lit(seed), "video_id", "win_start") <= keep_background))
    return kept.select("video_id", "win_start", "win_end", "is_background", F.when(F.col("is_background"), background_role).otherwise("action").alias("window_role"))


def action_windows(frames: DataFrame, size: int, per_segment: int, stride: int, seed: int = 0, label: str = "label") -> DataFrame:
    """(video_id, win_start, win_end): windows around each action, spread over the starts that show it whole, and moved by a bounded random step."""
    runs = action_spans(segments(frames, label)).join(lengths(frames), "video_id")
    last = F.greatest(F.col("num_frames") - size, F.lit(0))
    low, high = F.greatest(F.lit(0), F.col("seg_end") - size), F.least(F.col("seg_start"), last)
    centre = F.least(F.greatest(F.floor((F.col("seg_start") + F.col("seg_end") - size) / 2), F.lit(0)), last)
    steps = runs.select("video_id", "seg_start", "num_frames", low.alias("low"), high.alias("high"), centre.alias("centre"), F.explode(F.sequence(F.lit(0), F.lit(per_segment - 1))).alias("i"))
    jitter = max(1, stride // 2)
    anchor = F.bround(F.col("low") + (F.col("high") - F.col("low")) * F.col("i") / F.lit(float(max(per_segment - 1, 1))))
    moved = anchor + F.floor(hash_unit(F.lit(seed), "video_id", "seg_start", "i") * (2 * jitter + 1)) - jitter
    start = F.when(F.col("high") < F.col("low"), F.col("centre")).otherwise(F.least(F.greatest(moved, F.col("low")), F.col("high")))
    return steps.select("video_id", start.cast("int").alias("win_start"), "num_frames").distinct().select("video_id", "win_start", F.least(F.col("win_start") + size, F.col("num_frames")).cast("int").alias("win_end"))


def hard_negatives(candidates: DataFrame, action_windows: int | DataFrame, ratio: float, per_video: int, seed: int = 0) -> DataFrame:
    """A sample of candidate windows: at most per_video of each video and, of all, ratio times the action windows (one at least).

    action_windows: their number, or a DataFrame of one row with it in column n.
    """
    number = hash_unit(F.lit(seed), "video_id", "win_start")
    of_video = Window.partitionBy("video_id").orderBy("_u", "win_start")
    capped = candidates.withColumn("_u", number).withColumn("_r", F.row_number().over(of_video)).where(F.col("_r") <= per_video).drop("_r")
    n = capped.sparkSession.range(1).select(F.lit(action_windows).cast("long").alias("n")) if isinstance(action_windows, int) else action_windows
    # rounded first, so that a product a little above a whole number doesn't count as more
    target = n.select(F.greatest(F.ceil(F.round(F.col("n") * F.lit(float(ratio)), 9)), F.lit(1)).alias("_target"))
    drawn = ranked(capped, F.col("_u"), "video_id", "win_start").join(F.broadcast(target))  # one row
    return drawn.where((F.col("_rank") <= F.col("_target")) & F.lit(ratio > 0)).select(*candidates.columns)


def padded(windows: DataFrame, frames: DataFrame, size: int, values: list[str], label: str = "label", valid: str = "valid") -> DataFrame:
    """(video_id, win_start, pos, *values, label, valid): the rows of each window; past the end the last values, IGNORE and 0."""
    pos = windows.select("video_id", "win_start", "win_end", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("pos"))
    pos = pos.withColumn("frame", F.least(F.col("win_start") + F.col("pos"), F.col("win_end") - 1)).withColumn("_in", F.col("win_start") + F.col("pos") < F.col("win_end"))
    joined = pos.join(frames.select("video_id", "frame", *values, label, valid), ["video_id", "frame"])
    return joined.select("video_id", "win_start", "pos", *values, F.when(F.col("_in"), F.coalesce(label, F.lit(IGNORE))).otherwise(IGNORE).alias("label"), F.when(F.col("_in"), F.col(valid).cast("double")).otherwise(0.0).alias("valid"))


def window_label_counts(rows: DataFrame) -> DataFrame:
    """How often each label occurs in padded windows, without the padding."""
    return rows.where(F.col("label") != IGNORE).groupBy("label").agg(F.count("*").alias("n"))


def fused(windows: DataFrame, size: int) -> DataFrame:
    """(video_id, frame, class_id, score) from window scores (video_id, win_start, win_end, pos, class_id, logit): means over the windows of a frame, by Hamming weights over the window size."""
    inside = windows.where(F.col("win_start") + F.col("pos") < F.col("win_end")).withColumn("_w", hamming(F.col("pos"), size))
    keyed = inside.groupBy("video_id", (F.col("win_start") + F.col("pos")).cast("int").alias("frame"), "class_id")
    return keyed.agg((F.sum(F.col("logit").cast("double") * F.col("_w")) / F.greatest(F.sum("_w"), F.lit(1e-8))).alias("score"))


def fused_labels(scores: DataFrame) -> DataFrame:
    """(video_id, frame, pred): the class of the highest fused score, the smallest of equal ones."""
    best = F.max(F.struct("score", (-F.col("class_id")).alias("neg")))
    return scores.groupBy("video_id", "frame").agg((-best["neg"]).cast("int").alias("pred"))


def window_scores(windows: DataFrame, frames: DataFrame, logits: str = "logits") -> DataFrame:
    """Window scores of a scorer that gives each frame's own logits: the input of fused() when scores are at hand by frame."""
    pos = windows.select("video_id", "win_start", "win_end", F.explode(F.sequence(F.lit(0), F.col("win_end") - F.col("win_start") - 1)).alias("pos")).withColumn("frame", F.col("win_start") + F.col("pos"))
    # the arrays meet their windows whole, so the exchange carries a row for each frame, not for each class
    both = pos.join(frames.select("video_id", "frame", logits), ["video_id", "frame"])
    return both.select("video_id", "frame", "win_start", "win_end", "pos", F.posexplode(logits).alias("class_id", "logit"))


def window_accuracy(rows: DataFrame) -> DataFrame:
    """(label, n, accuracy) of window rows (label, pred), without the padding."""
    return rows.where(F.col("label") != IGNORE).groupBy("label").agg(F.count("*").alias("n"), F.avg((F.col("pred") == F.col("label")).cast("double")).alias("accuracy"))


def hard_negative_videos(frames: DataFrame, entries: DataFrame, label: str = "label") -> DataFrame:
    """(video_id) of the videos that are all background and whose entry (polarity, hard_negative_eligible) is a negative, eligible scene; texts for yes count as yes."""
    quiet = frames.groupBy("video_id").agg(F.every(F.coalesce(F.col(label) == BACKGROUND, F.lit(False))).alias("_quiet")).where("_quiet").select("video_id")
    yes = F.coalesce(F.lower(F.trim(F.col("hard_negative_eligible").cast("string"))).isin("1", "true", "yes", "y"), F.lit(False))
    fit = entries.where((F.lower(F.trim("polarity")) == "negative") & yes).select("video_id").distinct()
    return quiet.join(fit, "video_id")
