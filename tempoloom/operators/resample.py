"""Resampling to a lower frame rate, and the features of the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucket(frame: Column, source_fps: float, target_fps: float, offset: int = 0) -> Column:
    """The bucket of a frame when source_fps frames a second become target_fps; null before the offset.

    Bucket i begins at floor(i * r) for the ratio r of the rates, so a frame f
    is in bucket ceil((f + 1) / r) - 1.
    """
    if source_fps <= 0 or target_fps <= 0 or target_fps > source_fps + 1e-6 or offset < 0:
        raise ValueError("rates must be positive, the target no higher than the source, and the offset not negative")
    at = frame - offset
    return F.when(at >= 0, (F.ceil((at + 1) / F.lit(max(source_fps / target_fps, 1.0))) - 1).cast("int"))


def robust_mean(x: Column) -> Column:
    """The mean; of five values or more without one of the least and one of the greatest."""
    n = F.count(x)
    return F.when(n < 5, F.avg(x)).otherwise((F.sum(x) - F.min(x) - F.max(x)) / (n - 2))


def median_scale(palm: Column) -> Column:
    """The median of the finite values above 1e-3, 1 without any, and at least 1e-3."""
    good = F.when(~F.isnan(palm) & (F.abs(palm) < F.lit(float("inf"))) & (palm > 1e-3), palm.cast("double"))
    return F.greatest(F.coalesce(F.median(good), F.lit(1.0)), F.lit(1e-3))


def downsampled(frames: DataFrame, source_fps: float, target_fps: float, values: dict[str, Column], offset: int = 0) -> DataFrame:
    """(video_id, frame, *values): aggregates over the buckets; frame is the bucket's number."""
    placed = frames.withColumn("_bucket", bucket(F.col("frame"), source_fps, target_fps, offset)).where("_bucket IS NOT NULL")
    return placed.groupBy("video_id", F.col("_bucket").alias("frame")).agg(*(v.alias(k) for k, v in values.items()))


def mode_labels(frames: DataFrame, source_fps: float, target_fps: float, label: str = "label") -> DataFrame:
    """(video_id, frame, label): the most frequent label of each bucket, the smallest of equally frequent ones."""
    return downsampled(frames, source_fps, target_fps, {"label": F.mode(F.col(label), True)})


def tracks_aggregated(frames: DataFrame, source_fps: float, target_fps: float, channels: int, offset: int = 0) -> DataFrame:
    """(video_id, frame, coords, quality, valid): robust channel means over the median palm, mean quality, and validity by majority."""
    values = {f"_c{i}": robust_mean(F.get("coords", F.lit(i)).cast("double")) for i in range(channels)}
    values |= {"_scale": median_scale(F.col("palm")), "quality": F.avg("quality"), "valid": (F.avg(F.col("valid").cast("double")) > 0.5).cast("int")}
    out = downsampled(frames, source_fps, target_fps, values, offset)
    return out.select("video_id", "frame", F.array(*(F.col(f"_c{i}") / F.col("_scale") for i in range(channels))).alias("coords"), "quality", "valid")


def with_velocity(frames: DataFrame, fps: float, coords: str = "coords") -> DataFrame:
    """frames with velocity: the change of each channel since the last frame times fps, 0 in the first one."""
    if fps <= 0:
        raise ValueError("fps must be positive")
    before = F.lag(coords).over(Window.partitionBy("video_id").orderBy("frame"))
    zeros = F.transform(F.col(coords), lambda x: (x * 0).cast("double"))
    return frames.withColumn("velocity", F.coalesce(F.zip_with(F.col(coords), before, lambda a, b: ((a - b) * fps).cast("double")), zeros))


def feature_vector(quality: Column, valid: Column, coords: Column, velocity: Column) -> Column:
    """The channels of a frame in their order."""
    return F.concat(F.array(quality.cast("double"), valid.cast("double")), coords, velocity)
