"""Names, constants and schemas of the sequence model."""

from __future__ import annotations

from pyspark.sql import types as T

# The classes by id, the schema's version and the layout of a frame's channels.
ACTIONS = 14
BACKGROUND = 14
NUM_CLASSES = 15
IGNORE = -100
COORDS = 63
FEATURES = 128
WRIST, PALM_KNUCKLES = 0, (5, 9, 13, 17)
#: Channels whose sign a mirrored hand changes: x of each coordinate, then x of each velocity.
MIRROR_CHANNELS = tuple(range(2, 2 + COORDS, 3)) + tuple(range(2 + COORDS, FEATURES, 3))

_s, _i, _l, _f, _d, _b = T.StringType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


FRAMES = _struct(video_id=_s, frame=_i, label=_i, pred=_i, valid=_f, quality=_f, coords=T.ArrayType(_f), velocity=T.ArrayType(_f), logits=T.ArrayType(_f))
TRACKS = _struct(video_id=_s, frame=_i, landmarks=T.ArrayType(_f), tracking_quality=_f, valid_mask=_f, hand_side=T.ByteType(), source_fps=_f)
SEGMENTS = _struct(video_id=_s, seg_id=_i, label=_i, seg_start=_i, seg_end=_i)
WINDOWS = _struct(video_id=_s, win_start=_i, win_end=_i, is_background=_b, window_role=_s)
INTERVALS = _struct(video_id=_s, line_no=_i, start_sec=_d, end_sec=_d, label=_i, confidence=_d)
INVENTORY = _struct(
    source=_s, video_id=_s, directory_path=_s, video_path=_s, annotation_path=_s, subject_id=_s, gender=_s, field3=_s, scene_raw=_s, scene=_s, polarity=_s,
    status=_s, scene_category=_s, hard_negative_eligible=_b, taxonomy_version=_i, video_size=_l, video_mtime_ns=_l, annotation_sha256=_s, error=_s,
)
STATUS = _struct(video_id=_s, source=_s, status=_s, path=_s, error=_s)


def feature_names() -> list[str]:
    """The 128 channels of a frame, in order."""
    return ["tracking_quality", "v_mask", *(f"c_{i}" for i in range(COORDS)), *(f"v_{i}" for i in range(COORDS))]
