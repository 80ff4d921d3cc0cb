"""The One-Euro filter, a recursive low-pass filter whose cutoff follows the speed, over many videos in step."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Frames that are held until their videos are filtered together; a longer video is held alone.
TOGETHER = 1 << 17


def gain(cutoff, dt: float):
    """The weight of a new sample in a low-pass filter with this cutoff."""
    angle = 2 * math.pi * dt * cutoff
    return angle / (angle + 1)


def follow(value: np.ndarray, speed: np.ndarray, sample: np.ndarray, dt: float, min_cutoff: float, beta: float, d_cutoff: float) -> tuple[np.ndarray, np.ndarray]:
    """The next values and speeds of any number of channels; a value that isn't a number yet begins at its sample, at rest."""
    fresh = np.isnan(value)
    moved = speed + gain(d_cutoff, dt) * ((sample - value) / dt - speed)
    near = value + gain(min_cutoff + beta * np.abs(moved), dt) * (sample - value)
    return np.where(fresh, sample, near), np.where(fresh, 0.0, moved)


def filtered(samples: np.ndarray, usable: np.ndarray, lengths: np.ndarray, dt: float, min_cutoff: float, beta: float, d_cutoff: float, default: float) -> np.ndarray:
    """The filtered samples (frames, channels) of videos one after the other: the n-th frames of all videos in one step."""
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    running = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), side="left")  # videos longer than each step
    value = np.full((len(lengths), samples.shape[1]), np.nan)
    speed, out = np.zeros_like(value), np.empty(samples.shape)
    for step, n in enumerate(running.tolist()):
        at = starts[:n] + step
        good = np.flatnonzero(usable[at])
        value[good], speed[good] = follow(value[good], speed[good], samples[at[good]], dt, min_cutoff, beta, d_cutoff)
        out[at] = value[:n]
    return np.where(np.isnan(out), default, out)


def one_euro(frames: DataFrame, fps: float, value: str = "coords", valid: str = "valid", min_cutoff: float = 1.0, beta: float = 0.007, d_cutoff: float = 1.0, default: float = 0.0) -> DataFrame:
    """(video_id, frame, value): filtered on valid frames, the last filtered value elsewhere, default before the first.

    value is a number or an array of one length. The state of a frame depends on
    all before, so a video's frames go in order through one Arrow function,
    which filters many videos at once.
    """
    if fps <= 0:
        raise ValueError("fps must be positive")
    many = frames.schema[value].dataType.typeName() == "array"
    x = F.col(value).cast("array<double>") if many else F.array(F.col(value).cast("double"))
    finite = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(finite & (F.col(valid).cast("double") > 0.5), F.lit(False))
    rows = frames.select("video_id", F.col("frame").cast("int").alias("frame"), x.alias("x"), usable.alias("usable"))
    rows = rows.repartition("video_id").sortWithinPartitions("video_id", "frame")

    def smooth(batches):
        held: list[pa.RecordBatch] = []

        def done(table: pa.Table):
            table = table.combine_chunks()
            ids, x, ok = table.column(0), table.column(2), table.column(3).to_numpy()
            begins = np.flatnonzero(np.append(True, _differ(ids)))
            lengths = np.diff(np.append(begins, table.num_rows))
            sizes = np.diff(x.chunk(0).offsets.to_numpy()) if x.null_count == 0 else np.array([0 if v is None else len(v) for v in x.to_pylist()])
            width = int(sizes.max(initial=1))
            if (sizes[ok] != width).any():
                raise ValueError("arrays of one column have to be of one length")
            samples = np.zeros((table.num_rows, width))
            samples[ok] = x.filter(pa.array(ok)).combine_chunks().flatten().to_numpy().reshape(-1, width)
            out = filtered(samples, ok, lengths, 1.0 / fps, min_cutoff, beta, d_cutoff, default).astype(np.float32)
            flat = pa.array(out.ravel())
            column = pa.FixedSizeListArray.from_arrays(flat, width).cast(pa.list_(pa.float32())) if many else flat
            yield from pa.table([ids, table.column(1), column], names=["video_id", "frame", value]).to_batches(max_chunksize=10_000)

        for b in batches:
            held.append(b)
            if sum(h.num_rows for h in held) < TOGETHER:
                continue
            whole = pa.Table.from_batches(held)
            ids = whole.column(0)
            last = whole.num_rows - 1
            # the last video may go on in the next batch
            cuts = np.flatnonzero(_differ(ids))
            if not len(cuts):
                continue
            cut = int(cuts[-1]) + 1
            yield from done(whole.slice(0, cut))
            held = whole.slice(cut, last + 1 - cut).to_batches()
        if sum(h.num_rows for h in held):
            yield from done(pa.Table.from_batches(held))

    kind = "array<float>" if many else "float"
    return rows.mapInArrow(smooth, f"video_id {rows.schema['video_id'].dataType.simpleString()}, frame int, {value} {kind}")


def _differ(ids: pa.ChunkedArray) -> np.ndarray:
    """Whether each id but the first differs from the one before."""
    import pyarrow.compute as pc

    whole = ids.combine_chunks()
    if isinstance(whole, pa.ChunkedArray):
        whole = whole.chunk(0)
    same = pc.equal(whole.slice(1), whole.slice(0, len(whole) - 1))
    both = pc.and_(whole.slice(1).is_null(), whole.slice(0, len(whole) - 1).is_null())
    return ~pc.fill_null(pc.or_(pc.fill_null(same, False), both), False).to_numpy(zero_copy_only=False)
