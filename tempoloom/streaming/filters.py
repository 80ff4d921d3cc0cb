"""Streams of frames: the One-Euro filter and the runs of labels with state for each video."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.smoothing import follow


def one_euro_stream(frames: DataFrame, fps: float, min_cutoff: float = 1.0, beta: float = 0.007, d_cutoff: float = 1.0) -> DataFrame:
    """(video_id, frame, value) of a stream (video_id, frame, value double, valid int) whose frames of a video come in order from one micro-batch to the next.

    The state of a video is two numbers.
    """
    kind = frames.schema["video_id"].dataType.simpleString()

    def step(key, batches, state):
        value, speed = (np.array([x]) for x in (state.get if state.exists else (np.nan, 0.0)))
        pdf = pd.concat(list(batches)).sort_values("frame")
        out = []
        for x, ok in zip(pdf["value"], pdf["valid"], strict=True):
            if ok > 0.5 and np.isfinite(x):
                value, speed = follow(value, speed, np.array([x]), 1.0 / fps, min_cutoff, beta, d_cutoff)
            out.append(0.0 if np.isnan(value[0]) else float(value[0]))
        if not np.isnan(value[0]):
            state.update((float(value[0]), float(speed[0])))
        yield pd.DataFrame({"video_id": key[0], "frame": pdf["frame"].to_numpy(), "value": out})

    return frames.groupBy("video_id").applyInPandasWithState(step, f"video_id {kind}, frame int, value double", "value double, speed double", "append", GroupStateTimeout.NoTimeout)


def runs_stream(frames: DataFrame) -> DataFrame:
    """(video_id, label, seg_start, seg_end) of each run of a stream (video_id, frame, label) once the next run begins."""
    kind = frames.schema["video_id"].dataType.simpleString()

    def step(key, batches, state):
        label, start = state.get if state.exists else (None, None)
        pdf = pd.concat(list(batches)).sort_values("frame")
        out = []
        for f, x in zip(pdf["frame"].tolist(), pdf["label"].tolist(), strict=True):
            if label is None:
                label, start = x, f
            elif x != label:
                out.append((key[0], label, start, f))
                label, start = x, f
        if label is not None:
            state.update((int(label), int(start)))
        yield pd.DataFrame(out, columns=["video_id", "label", "seg_start", "seg_end"])

    return frames.groupBy("video_id").applyInPandasWithState(step, f"video_id {kind}, label int, seg_start int, seg_end int", "label int, seg_start int", "append", GroupStateTimeout.NoTimeout)
