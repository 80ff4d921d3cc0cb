"""The assembly of sequences from source-rate tracks: geometry, smoothing, resampling, labels, features and audit in one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import audit, catalog, landmarks, resample, smoothing
from ..operators.timeline import intervals_to_frames
from ..schema import COORDS


@dataclass(frozen=True)
class Assembly:
    target_fps: float = 15.0
    min_cutoff: float = 1.0
    beta: float = 0.007
    d_cutoff: float = 1.0
    edge_trim: float = 0.2
    aspect_ratio: float = 1.0


def source_tracks(tracks: DataFrame, fps: float, config: Assembly) -> DataFrame:
    """(video_id, frame, coords, palm, valid, quality, side): centred, smoothed and filled at the source rate.

    tracks: (video_id, frame, landmarks, valid, quality, side). Coordinates and
    palm size go through one filter pass, the palm as one more channel.
    """
    points = F.when(F.col("side") == -1, landmarks.mirrored(F.col("landmarks"))).otherwise(F.col("landmarks"))
    points = landmarks.aspect_corrected(points, config.aspect_ratio)
    usable = (F.col("valid") > 0.5) & ~F.exists("landmarks", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    placed = tracks.select("video_id", "frame", "valid", "quality", "side", usable.cast("int").alias("usable"), points.alias("p"))
    joined = F.concat(landmarks.centred(F.col("p")), F.array(landmarks.palm_size(F.col("p")).cast("double")))
    smooth = smoothing.one_euro(placed.withColumn("x", joined.cast("array<float>")), fps, "x", "usable", config.min_cutoff, config.beta, config.d_cutoff)
    out = smooth.join(placed.drop("p"), ["video_id", "frame"])
    # before the first usable frame the coordinates are 0 and the palm is 1
    palm = F.get("x", F.lit(COORDS))
    return out.select("video_id", "frame", F.slice("x", 1, COORDS).cast("array<double>").alias("coords"), F.when(palm == 0, 1.0).otherwise(palm).alias("palm"), "valid", "quality", "side")


def assembled(tracks: DataFrame, intervals: DataFrame, fps: float, config: Assembly = Assembly()) -> tuple[DataFrame, DataFrame]:
    """The frames at the target rate (video_id, frame, label, quality, valid, coords, velocity), and the audit at the source rate."""
    source = source_tracks(tracks, fps, config)
    videos = tracks.groupBy("video_id").agg((F.max("frame") + 1).cast("int").alias("num_frames")).withColumn("fps", F.lit(float(fps)))
    labels = intervals_to_frames(videos, intervals)
    frames = resample.tracks_aggregated(source, fps, config.target_fps, COORDS)
    frames = frames.join(resample.mode_labels(labels, fps, config.target_fps), ["video_id", "frame"])
    report = audit.sequence_audit(source.join(labels, ["video_id", "frame"]), fps, config.edge_trim).join(landmarks.hand_sides(source), "video_id")
    return resample.with_velocity(frames, config.target_fps), report


def outcome(entries: DataFrame, tracks: DataFrame, labels: DataFrame) -> DataFrame:
    """entries with their status: ready, missing_track, or annotation_conflict for a negative scene with an action."""
    out = catalog.with_state(entries, tracks.select("source", "video_id"))
    bad = catalog.conflicts(labels, out).select("video_id", F.lit(True).alias("_bad"))
    return out.join(bad, "video_id", "left").withColumn("status", F.when(F.col("_bad"), "annotation_conflict").otherwise(F.col("status"))).drop("_bad")
