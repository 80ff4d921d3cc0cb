"""Geometry of hand landmarks (21 points of x, y, z in one array) and the choice of a hand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import COORDS, MIRROR_CHANNELS, PALM_KNUCKLES


def centred(points: Column) -> Column:
    """The points relative to the wrist."""
    return F.transform(points, lambda x, i: x - F.get(points, i % 3))


def palm_size(points: Column) -> Column:
    """The mean distance of four knuckles from the wrist, at least 1e-3."""
    at = lambda i: F.get(points, F.lit(i)).cast("double")
    bones = [F.sqrt(sum(((at(3 * k + a) - at(a)) * (at(3 * k + a) - at(a)) for a in range(1, 3)), (at(3 * k) - at(0)) * (at(3 * k) - at(0)))) for k in PALM_KNUCKLES]
    return F.greatest(sum(bones[1:], bones[0]) / len(bones), F.lit(1e-3))


def aspect_corrected(points: Column, aspect: Column | float) -> Column:
    """x and z scaled by width / height, so that all axes are in heights."""
    if isinstance(aspect, (int, float)):
        if aspect <= 0:
            raise ValueError("the aspect ratio must be positive")
        aspect = F.lit(float(aspect))
    return F.transform(points, lambda x, i: F.when(i % 3 != 1, x * aspect).otherwise(x.cast("double")))


def mirrored(points: Column) -> Column:
    """A left hand as a right one: x becomes 1 - x."""
    return F.transform(points, lambda x, i: F.when(i % 3 == 0, 1 - x).otherwise(x))


def normalised(points: Column) -> Column:
    """Wrist-centred points in palm sizes."""
    size = palm_size(points)
    return F.transform(centred(points), lambda x: x / size)


def mirrored_features(features: Column) -> Column:
    """The channels of a frame with the sign of every x changed."""
    rows = F.array(*(F.lit(i) for i in MIRROR_CHANNELS))
    return F.transform(features, lambda x, i: F.when(F.array_contains(rows, i), -x).otherwise(x))


def frame_coords(points: Column, side: Column, aspect: Column | float) -> Column:
    """The wrist-centred coordinates of a source frame: mirrored for a left hand (side -1), then corrected for the aspect ratio."""
    return centred(aspect_corrected(F.when(side == -1, mirrored(points)).otherwise(points), aspect))


def label_for_hand(hand: str, mirrored_input: bool) -> str:
    """The detector's label for a physical hand, which is the other one on images that aren't mirrored."""
    hand = hand.strip().lower()
    if hand not in ("left", "right"):
        raise ValueError(f"no such hand: {hand}")
    return (hand if mirrored_input else {"left": "right", "right": "left"}[hand]).capitalize()


def strict_hand(candidates: DataFrame, side: int, threshold: float) -> DataFrame:
    """(video_id, frame, hand_no, score) of candidates (video_id, frame, hand_no, side, score): the best confident hand of one side, the first of equal ones."""
    good = candidates.where((F.col("score") >= threshold) & (F.col("side") == side))
    best = F.max(F.struct("score", (-F.col("hand_no")).alias("neg")))
    return good.groupBy("video_id", "frame").agg(best.alias("b")).select("video_id", "frame", (-F.col("b.neg")).alias("hand_no"), F.col("b.score").alias("score"))


def auto_hand(candidates: DataFrame, threshold: float) -> DataFrame:
    """(video_id, frame, hand_no, side, score): the best confident hand, of the side seen last if there is one of it.

    The side seen last depends on the choices before, so it is a fold over a
    video's frames: the list of (frame, best hand of either side) is short, as
    only one entry for each side of a frame is kept.
    """
    good = candidates.where(F.col("score") >= threshold)
    best = F.max(F.struct("score", (-F.col("hand_no")).alias("neg")))
    sides = good.groupBy("video_id", "frame", "side").agg(best.alias("b")).select("video_id", "frame", "side", F.col("b.score").alias("score"), (-F.col("b.neg")).alias("hand_no"))
    pairs = sides.groupBy("video_id", "frame").agg(F.sort_array(F.collect_list(F.struct(F.col("score"), (-F.col("hand_no")).alias("neg"), F.col("side").cast("int").alias("side"))), asc=False).alias("hands"))
    # where only one side is seen it decides; where both are, the side of the last frame decides, which the best of all starts
    single = F.when(F.size("hands") == 1, F.get("hands", F.lit(0))["side"])
    order = Window.partitionBy("video_id").orderBy("frame")
    # the state changes only at frames with one side, or at the first frame at all
    first = F.row_number().over(order) == 1
    told = F.when(first, F.get("hands", F.lit(0))["side"]).otherwise(single)
    state = F.last(told, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    chosen = F.get(F.filter("hands", lambda h: h["side"] == F.col("state")), F.lit(0))
    return pairs.withColumn("state", state).withColumn("h", chosen).select("video_id", "frame", (-F.col("h.neg")).alias("hand_no"), F.col("h.side").alias("side"), F.col("h.score").alias("score"))


def hand_sides(frames: DataFrame) -> DataFrame:
    """(video_id, left_hand_ratio, hand_side): the share of left hands among the tracked frames, and its name."""
    left = F.coalesce(F.avg(F.when(F.col("side") != 0, (F.col("side") == -1).cast("double"))), F.lit(0.0))
    name = F.when(F.col("left_hand_ratio") == 0, "physical_right").when(F.col("left_hand_ratio") == 1, "physical_left_mirrored").otherwise("mixed_mirrored")
    return frames.groupBy("video_id").agg(left.alias("left_hand_ratio")).withColumn("hand_side", name)


def landmark_count() -> int:
    return COORDS // 3
