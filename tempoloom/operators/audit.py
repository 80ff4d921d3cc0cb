"""Quality of tracked sequences at the source rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import ratio
from ..schema import BACKGROUND
from .timeline import longest_missing, with_runs

#: Jumps that a rate needs to be reliable.
LEAST_JUMPS = 10


def with_core(frames: DataFrame, trim: float, label: str = "label") -> DataFrame:
    """frames with core: inside an action, at least trim of its length from either end."""
    if not 0 <= trim < 0.5:
        raise ValueError("the trim must be in [0, 0.5)")
    runs = with_runs(frames, label, "_run")
    run = Window.partitionBy("video_id", "_run")
    low, high = F.min("frame").over(run), F.max("frame").over(run)
    cut = F.floor((high - low + 1) * trim)
    inside = (F.col(label) != BACKGROUND) & F.col("frame").between(low + cut, high - cut)
    return runs.withColumn("core", F.coalesce(inside, F.lit(False))).drop("_run")


def _rate(valid: Column, where: Column) -> Column:
    return F.avg(F.when(where, valid))


def detection_rates(frames: DataFrame, trim: float = 0.2, label: str = "label", valid: str = "valid") -> DataFrame:
    """(video_id, detection_rate, core_detection_rate): over the action frames and their cores, over all frames where there are none."""
    ok = (F.col(valid) > 0.5).cast("double")
    rows = with_core(frames, trim, label)
    action = F.coalesce(F.col(label) != BACKGROUND, F.lit(False))
    return rows.groupBy("video_id").agg(F.coalesce(_rate(ok, action), F.avg(ok)).alias("detection_rate"), F.coalesce(_rate(ok, F.col("core")), F.avg(ok)).alias("core_detection_rate"))


def class_rates(frames: DataFrame, trim: float = 0.2, label: str = "label", valid: str = "valid") -> DataFrame:
    """(video_id, class_id, detection_rate, core_detection_rate) of the actions of each video."""
    ok = (F.col(valid) > 0.5).cast("double")
    rows = with_core(frames, trim, label).where(F.col(label) != BACKGROUND)
    return rows.groupBy("video_id", F.col(label).alias("class_id")).agg(F.avg(ok).alias("detection_rate"), _rate(ok, F.col("core")).alias("core_detection_rate"))


def worst_class(rates: DataFrame, rate: str = "detection_rate") -> DataFrame:
    """(video_id, min_class_id, min_class_rate): the class of the lowest rate, the first of equal ones."""
    least = F.min(F.struct(F.col(rate).alias("r"), F.col("class_id").alias("c")))
    return rates.where(F.col(rate).isNotNull()).groupBy("video_id").agg(least.alias("m")).select("video_id", F.col("m.c").alias("min_class_id"), F.col("m.r").alias("min_class_rate"))


def _good(palm: Column) -> Column:
    return F.when(~F.isnan(palm) & (F.abs(palm) < F.lit(float("inf"))) & (palm > 1e-3), palm.cast("double"))


def palm_outliers(frames: DataFrame, palm: str = "palm") -> DataFrame:
    """(video_id, palm_outlier_rate): frames whose palm is more than three medians from the median, and 1 without any good palm."""
    # the palms of a video, one number a frame, are listed once instead of joining frames with their own median
    lists = frames.groupBy("video_id").agg(F.collect_list(F.col(palm).cast("double")).alias("_p"), F.median(_good(F.col(palm))).alias("_m"))
    far = F.filter("_p", lambda p: F.abs(p - F.col("_m")) > F.greatest(3 * F.col("_m"), F.lit(1e-3)))
    return lists.select("video_id", F.when(F.col("_m").isNull(), 1.0).otherwise(ratio(F.size(far), F.size("_p"))).alias("palm_outlier_rate"))


def jump_rate(frames: DataFrame, coords: str = "coords", palm: str = "palm", valid: str = "valid") -> DataFrame:
    """(video_id, trajectory_jump_rate, trajectory_jump_reliable): steps between valid frames, in palm sizes, that are far above the median step."""
    order = Window.partitionBy("video_id").orderBy("frame")
    before, was = F.lag(coords).over(order), F.lag(valid).over(order)
    square = F.aggregate(F.zip_with(F.col(coords), before, lambda a, b: ((a - b) * (a - b)).cast("double")), F.lit(0.0), lambda s, x: s + x)
    steps = frames.select("video_id", F.when((F.col(valid) > 0.5) & (was > 0.5), F.sqrt(square)).alias("_d"), _good(F.col(palm)).alias("_p"))
    scale = F.greatest(F.coalesce(F.median("_p"), F.lit(1.0)), F.lit(1e-3))
    # one exchange: a video's steps as a list, and what is asked of them from the list
    own = steps.groupBy("video_id").agg(scale.alias("_s"), F.sort_array(F.collect_list("_d")).alias("_d")).withColumn("_d", F.transform("_d", lambda d: d / F.col("_s")))
    middle = lambda c: F.when(F.size(c) > 0, (F.get(c, F.expr(f"(size({c}) - 1) div 2").cast("int")) + F.get(c, F.expr(f"size({c}) div 2").cast("int"))) / 2)
    own = own.withColumn("_m", middle("_d")).withColumn("_a", F.sort_array(F.transform("_d", lambda d: F.abs(d - F.col("_m"))))).withColumn("_mad", middle("_a"))
    limit = F.col("_m") + 6 * F.greatest("_mad", 0.1 * F.col("_m"), F.lit(1e-6))
    enough = F.size("_d") >= LEAST_JUMPS
    far = ratio(F.size(F.filter("_d", lambda d: d > limit)), F.size("_d"))
    return own.select("video_id", F.when(enough, far).otherwise(0.0).alias("trajectory_jump_rate"), enough.alias("trajectory_jump_reliable"))


def quality_gate(rows: DataFrame, threshold: float, class_threshold: float, exclude_unknown: bool = True) -> DataFrame:
    """rows with scene_valid, quality_passed and status; the core rates fall back on the plain ones, those on 0. A row with a load_error is neither passed nor rejected."""
    plain = F.coalesce(F.col("detection_rate"), F.lit(0.0))
    least = F.coalesce(F.col("min_class_detection_rate"), plain)
    core, core_least = F.coalesce(F.col("core_detection_rate"), plain), F.coalesce(F.col("min_class_core_detection_rate"), least)
    valid = ~F.col("polarity").eqNullSafe("unknown")  # no polarity at all is not an unknown one
    passed = (core >= threshold) & (core_least >= class_threshold) & (valid if exclude_unknown else F.lit(True))
    out = rows.withColumn("scene_valid", valid)
    if "load_error" in rows.columns:  # what couldn't be read has no rates to go by
        unread = F.col("load_error").isNotNull()
        return out.withColumn("quality_passed", passed & ~unread).withColumn("status", F.when(unread, "load_failed").when(passed, "passed").otherwise("rejected"))
    return out.withColumn("quality_passed", passed).withColumn("status", F.when(passed, "passed").otherwise("rejected"))


def quality_verdict(rows: DataFrame, frames: DataFrame, threshold: float) -> DataFrame:
    """(video_id, detection_rate, low_quality) for inference: the stated rate, else that of the frames, else 0."""
    own = frames.groupBy("video_id").agg(F.avg((F.col("valid") > 0.5).cast("double")).alias("_own"))
    rate = F.coalesce("detection_rate", "_own", F.lit(0.0))
    return rows.join(own, "video_id", "left").select("video_id", rate.alias("detection_rate"), (rate < threshold).alias("low_quality"))


def sequence_audit(frames: DataFrame, fps: float, trim: float = 0.2) -> DataFrame:
    """All measures of a sequence in one row for each video (frames with label, valid, palm, coords)."""
    rates = class_rates(frames, trim)
    core = worst_class(rates, "core_detection_rate").withColumnsRenamed({"min_class_id": "min_class_core_id", "min_class_rate": "min_class_core_detection_rate"})
    worst = worst_class(rates).withColumnRenamed("min_class_rate", "min_class_detection_rate")
    out = detection_rates(frames, trim)
    for part in (worst, core, longest_missing(frames, fps), palm_outliers(frames), jump_rate(frames)):
        out = out.join(part, "video_id", "left")
    return out.withColumn("min_class_detection_rate", F.coalesce("min_class_detection_rate", "detection_rate")).withColumn("min_class_core_detection_rate", F.coalesce("min_class_core_detection_rate", "core_detection_rate"))


def sequence_summary(frames: DataFrame) -> DataFrame:
    """(video_id, num_frames, valid_ratio, label_counts)."""
    counts = frames.groupBy("video_id", "label").agg(F.count("*").alias("n"), F.sum((F.col("valid") > 0.5).cast("long")).alias("ok"))
    pairs = F.filter(F.sort_array(F.collect_list(F.struct("label", "n"))), lambda x: x["label"].isNotNull())
    return counts.groupBy("video_id").agg(F.sum("n").alias("num_frames"), (F.sum("ok") / F.sum("n")).alias("valid_ratio"), F.map_from_entries(pairs).alias("label_counts"))


