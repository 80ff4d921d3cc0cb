"""Scoring windows with a pluggable model, in Arrow batches.

A scorer takes an array (windows, channels, positions) and gives one (windows,
classes, positions). A dilated temporal convolution network is built in as
plain array arithmetic over given weights; others can be registered by name.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Scorer = Callable[[np.ndarray], np.ndarray]
_BUILDERS: dict[str, Callable[..., Scorer]] = {}


def register(name: str):
    def keep(builder):
        _BUILDERS[name] = builder
        return builder

    return keep


def build(name: str, **params) -> Scorer:
    if name not in _BUILDERS:
        raise ValueError(f"no such model: {name}; there are {', '.join(sorted(_BUILDERS))}")
    return _BUILDERS[name](**params)


def _conv(x: np.ndarray, weight: np.ndarray, bias: np.ndarray, dilation: int = 1) -> np.ndarray:
    """x (n, in, t) through weight (out, in, width), zero-padded to its length."""
    width = weight.shape[2]
    pad = dilation * (width // 2)
    padded = np.pad(x, ((0, 0), (0, 0), (pad, pad)))
    t = x.shape[2]
    out = sum(np.einsum("oi,nit->not", weight[:, :, k], padded[:, :, k * dilation : k * dilation + t]) for k in range(width))
    return out + bias[None, :, None]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@register("ms_tcn2")
def ms_tcn2(weights: dict[str, np.ndarray]) -> Scorer:
    """A generation stage of dual dilated layers and any number of refinement stages, without dropout; weights are keyed by the names of their layers."""
    relu = lambda x: np.maximum(x, 0)
    layer = lambda x, name, dilation=1: _conv(x, weights[f"{name}.weight"], weights[f"{name}.bias"], dilation)
    count = lambda prefix: len({k[len(prefix) :].split(".")[0] for k in weights if k.startswith(prefix)})

    def score(x: np.ndarray) -> np.ndarray:
        n = count("PG.conv_dilated_1.")
        f = layer(x, "PG.conv_1x1_in")
        for i in range(n):
            both = np.concatenate([layer(f, f"PG.conv_dilated_1.{i}", 2 ** (n - 1 - i)), layer(f, f"PG.conv_dilated_2.{i}", 2**i)], axis=1)
            f = relu(layer(both, f"PG.conv_fusion.{i}")) + f
        out = layer(f, "PG.conv_out")
        for r in range(count("Rs.")):
            f = layer(_softmax(out), f"Rs.{r}.conv_1x1")
            for i in range(count(f"Rs.{r}.layers.")):
                f = f + layer(relu(layer(f, f"Rs.{r}.layers.{i}.conv_dilated", 2**i)), f"Rs.{r}.layers.{i}.conv_1x1")
            out = layer(f, f"Rs.{r}.conv_out")
        return out

    return score


@register("linear")
def linear(weights: np.ndarray, bias: np.ndarray | None = None) -> Scorer:
    """Each position by itself: weights (classes, channels)."""
    w = np.asarray(weights)
    b = np.zeros(len(w)) if bias is None else np.asarray(bias)
    return lambda x: np.einsum("oi,nit->not", w, x) + b[None, :, None]


def scored_windows(padded: DataFrame, scorer: Scorer, size: int, batch: int = 256, features: str = "features") -> DataFrame:
    """(video_id, win_start, win_end, pos, class_id, logit), the input of windows.fused(), from padded windows (video_id, win_start, pos, features, valid, label) and win_end."""
    whole = padded.groupBy("video_id", "win_start", "win_end").agg(F.sort_array(F.collect_list(F.struct("pos", F.col(features).alias("x")))).alias("rows"))
    kind = whole.schema["video_id"].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                x = np.array([[np.asarray(r["x"], dtype=np.float32) for r in rows] for rows in part["rows"]]).transpose(0, 2, 1)
                y = scorer(x)
                classes = y.shape[1]
                for (v, a, b), scores in zip(part[["video_id", "win_start", "win_end"]].itertuples(index=False), y, strict=True):
                    yield pd.DataFrame({"video_id": v, "win_start": a, "win_end": b, "pos": np.repeat(np.arange(size, dtype=np.int32), classes), "class_id": np.tile(np.arange(classes, dtype=np.int32), size), "logit": scores.T.ravel().astype(np.float64)})

    return whole.mapInPandas(run, f"video_id {kind}, win_start int, win_end int, pos int, class_id int, logit double")


def check_weights(weights: dict[str, np.ndarray], channels: int, classes: int, version: str | None = None, expected: str | None = None) -> None:
    """Raises unless a checkpoint fits the data: its version, its input channels and its classes."""
    if expected is not None and version != expected:
        raise ValueError(f"the checkpoint has schema {version}, not {expected}")
    for name, axis, n in (("PG.conv_1x1_in.weight", 1, channels), ("PG.conv_out.weight", 0, classes)):
        if name not in weights:
            raise ValueError(f"the checkpoint lacks {name}")
        if weights[name].shape[axis] != n:
            raise ValueError(f"{name} has {weights[name].shape[axis]} instead of {n}")
