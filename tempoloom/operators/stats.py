"""Distribution reports: run lengths by class, gaps, scenes, and what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import BACKGROUND, NUM_CLASSES
from .timeline import action_spans


def nearest_rank(column: str, q: float) -> Column:
    """The value at rank ceil(q * n) of the sorted values, 0 without any."""
    return F.coalesce(F.expr(f"percentile_disc({q!r}) WITHIN GROUP (ORDER BY {column})"), F.lit(0))


def class_run_stats(runs: DataFrame, window: int, fps: float, by: tuple[str, ...] = ()) -> DataFrame:
    """One row for each class of action (and by): how many runs, how long, and how many exceed a window."""
    runs = action_spans(runs).withColumn("n", (F.col("seg_end") - F.col("seg_start")).cast("int"))
    rank = lambda q: nearest_rank("n", q).cast("int")
    out = runs.groupBy(*by, F.col("label").alias("class_id")).agg(
        F.count("*").alias("segments"), F.sum("n").cast("long").alias("frames_total"), F.avg("n").alias("mean_frames"),
        rank(0.5).alias("p50_frames"), rank(0.9).alias("p90_frames"), rank(0.95).alias("p95_frames"), rank(0.99).alias("p99_frames"), F.max("n").alias("max_frames"), F.count_if(F.col("n") > window).alias("over_window"),
    )
    total = F.sum("segments").over(Window.partitionBy(*[F.lit(1), *by]))
    return out.withColumn("share", F.col("segments") / total).withColumn("over_window_share", F.col("over_window") / F.col("segments")).withColumn("starts_p50", F.greatest(F.lit(window) - F.col("p50_frames") + 1, F.lit(0))).withColumn("p50_sec", F.col("p50_frames") / F.lit(float(fps))).withColumn("p95_sec", F.col("p95_frames") / F.lit(float(fps)))


def action_gaps(runs: DataFrame) -> DataFrame:
    """(video_id, gap): the frames between neighbouring actions of a video."""
    after = F.lead("seg_start").over(Window.partitionBy("video_id").orderBy("seg_start"))
    return action_spans(runs).select("video_id", (after - F.col("seg_end")).alias("gap")).where("gap IS NOT NULL")


def gap_percentiles(gaps: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(p05, p25, p50) of the gaps."""
    return gaps.groupBy(*by).agg(*(nearest_rank("gap", q).cast("int").alias(f"p{round(q * 100):02d}") for q in (0.05, 0.25, 0.5)))


def missing_classes(runs: DataFrame, classes: int = NUM_CLASSES) -> DataFrame:
    """(class_id): the actions that no run has."""
    dim = runs.sparkSession.range(classes).select(F.col("id").cast("int").alias("class_id")).where(F.col("class_id") != BACKGROUND)
    return dim.join(runs.select(F.col("label").alias("class_id")), "class_id", "left_anti")


def group_stats(videos: DataFrame, by: tuple[str, ...] = ("grp",)) -> DataFrame:
    """(by, videos, unlabelled, subjects) of videos (labelled, subject_id)."""
    return videos.groupBy(*by).agg(F.count("*").alias("videos"), F.count_if(~F.col("labelled")).alias("unlabelled"), F.countDistinct(F.nullif(F.col("subject_id"), F.lit(""))).alias("subjects"))


def scene_counts(videos: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, scene, polarity, videos), unknown where there is none."""
    known = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unknown")).alias(c)
    return videos.groupBy(*by, known("scene"), known("polarity")).agg(F.count("*").alias("videos"))


def source_groups(videos: DataFrame, sources: list[str] | None = None, known: list[str] | None = None) -> DataFrame:
    """videos with grp: each source is its own group, or those listed make up one and the others go."""
    if not sources:
        return videos.withColumn("grp", F.col("source"))
    listed = list(dict.fromkeys(sources))
    if known is not None and (missing := [s for s in listed if s not in known]):
        raise ValueError(f"no such sources: {missing}")
    return videos.where(F.col("source").isin(listed)).withColumn("grp", F.lit("+".join(listed)))


def render(rows: list[dict], columns: list[str]) -> str:
    """A small report as fixed-width text."""
    text = [[c, *(f"{r[c]:.3f}" if isinstance(r[c], float) else "" if r[c] is None else str(r[c]) for r in rows)] for c in columns]
    width = [max(map(len, t)) for t in text]
    return "\n".join("  ".join(t[i].rjust(w) for t, w in zip(text, width, strict=True)) for i in range(len(rows) + 1))
