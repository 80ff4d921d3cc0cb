"""BagMinHash: signatures whose entries agree with a probability of exactly the weighted Jaccard likeness of two multisets.

The weights are discretised to multiples of a quantum (for word shingles: the
number of occurrences). On the axis of weights, the unit steps [0, 1) and
[1, 2) and the dyadic ranges [2, 4), [4, 8), ... of an element each have an own
Poisson process, with the length of the range as rate and the element and the
range as random key. The first point of a range is split down hierarchically:
a half of the range inherits it, the other half begins its own process after
it, halves that lie above the element's weight are dropped, and single steps go
on with exponential gaps. A range that the weight covers in full may use its
point before it is split. Each point falls into one of the m entries of the
signature, whose value is the earliest point's identity.

Only points before a horizon T are made; T is set so that all entries get a
point with high probability, and is doubled where one did not, so signatures
are exact whatever T was. A range splits only if its first point is before T,
so a count of a million costs about twenty steps, not a million.
"""

from __future__ import annotations

import math

import numpy as np

from .common import U64, mix64

_NODE, _POINT, _SIDE = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)


def _uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _node_key(element: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(element ^ mix64(low.astype(U64) * _NODE + high.astype(U64) * _POINT))


class _Points:
    """The points made so far: their places, identities and nothing else."""

    def __init__(self):
        self.x: list[np.ndarray] = []
        self.id: list[np.ndarray] = []

    def add(self, x: np.ndarray, id_: np.ndarray) -> None:
        if len(x):
            self.x.append(x)
            self.id.append(id_)


def _leaves(points: _Points, key: np.ndarray, begin: np.ndarray, horizon: float) -> None:
    """The points of single steps with these keys after begin and before the horizon."""
    made = 0
    with np.errstate(over="ignore"):
        while len(key):
            span = horizon - float(begin.min())
            n = int(min(64 + (1 << 14) // len(key), math.ceil(span + 4 * math.sqrt(span) + 4)))
            bits = mix64(key[:, None] + (np.arange(made + 1, made + n + 1, dtype=U64) * _POINT)[None, :])
            x = begin[:, None] + np.cumsum(-np.log(_uniform(bits)), axis=1)
            inside = x < horizon
            points.add(x[inside], bits[inside])
            more = inside[:, -1]
            key, begin, made = key[more], x[more, -1], made + n


def _split(points: _Points, element: np.ndarray, low: np.ndarray, high: np.ndarray, weight: np.ndarray, horizon: float) -> None:
    """The points of dyadic ranges of more than one step."""
    key = _node_key(element, low, high)
    with np.errstate(over="ignore"):
        bits = mix64(key + _POINT)
    x = -np.log(_uniform(bits)) / (high - low)
    fresh = np.ones(len(x), dtype=bool)
    while len(x):
        near = x < horizon
        element, low, high, weight, x, bits, fresh = (a[near] for a in (element, low, high, weight, x, bits, fresh))
        if not len(x):
            return
        whole = high <= weight
        points.add(x[whole & fresh], bits[whole & fresh])
        fresh = fresh & ~whole
        step = high - low == 1
        if step.any():
            _leaves(points, _node_key(element[step], low[step], high[step]), x[step], horizon)
            element, low, high, weight, x, bits, fresh = (a[~step] for a in (element, low, high, weight, x, bits, fresh))
        if not len(x):
            return
        middle = (low + high) // 2
        with np.errstate(over="ignore"):
            left = (mix64(_node_key(element, low, high) + _SIDE) & U64(1)).astype(bool)
        heir = np.where(left, low, middle), np.where(left, middle, high)
        rest = np.where(left, middle, low), np.where(left, high, middle)
        with np.errstate(over="ignore"):
            new = mix64(_node_key(element, *rest) + _POINT)
        after = x - np.log(_uniform(new)) / (rest[1] - rest[0])
        low, high = np.concatenate((heir[0], rest[0])), np.concatenate((heir[1], rest[1]))
        element, weight = np.concatenate((element, element)), np.concatenate((weight, weight))
        x, bits, fresh = np.concatenate((x, after)), np.concatenate((bits, new)), np.concatenate((fresh, np.ones(len(after), dtype=bool)))
        inside = low < weight
        element, low, high, weight, x, bits, fresh = (a[inside] for a in (element, low, high, weight, x, bits, fresh))


def bag_minhash(elements: np.ndarray, weights: np.ndarray, m: int = 128) -> np.ndarray:
    """m entries of 64 bits for a multiset that isn't empty: distinct 64-bit elements with whole weights of 1 or more."""
    total = float(weights.sum())
    horizon = m * (math.log(m) + 3) / total
    units = _node_key(elements, np.zeros(len(elements), dtype=np.int64), np.ones(len(elements), dtype=np.int64))
    two = elements[weights >= 2]
    if len(two):
        ones = np.ones(len(two), dtype=np.int64)
        units = np.concatenate((units, _node_key(two, ones, 2 * ones)))
    while True:
        points = _Points()
        _leaves(points, units, np.zeros(len(units)), horizon)
        low = 2
        while (above := weights > low).any():
            n = int(above.sum())
            _split(points, elements[above], np.full(n, low, dtype=np.int64), np.full(n, 2 * low, dtype=np.int64), weights[above], horizon)
            low *= 2
        if points.x:
            x, id_ = np.concatenate(points.x), np.concatenate(points.id)
            slot = (mix64(id_ ^ _SIDE) % U64(m)).astype(np.int64)
            order = np.argsort(x, kind="stable")
            found, first = np.unique(slot[order], return_index=True)
            if len(found) == m:
                return id_[order[first]]
        horizon *= 2
