"""Quality classifier by co-training on two views, text content and page metadata.

The text view sees words and pairs of words by hash, and the shape of the text;
the metadata view the values of some columns and the stated length. Each has a
logistic classifier fitted to labelled documents. In each of some rounds, each
view labels all documents without a label about which it is confident by its
calibrated probability, for the other view, which is then fitted anew to
both. At last both views are calibrated on labelled documents they were not
fitted to (Platt scaling), and their log odds are added, less the prior that
both hold, to score every document.

The views of all documents are written once to the shared folder. The fit goes
over them a few times, each time adding up counts, loss, slope and curvature of
the pseudo-labels, a matrix of a fixed size from each task. At most ``LABELLED``
labelled documents are fitted to, those with the least hashes of their keys;
the pseudo-labels of a class weigh half as much as its labels together.

Edge cases: a null text is empty, null metadata is a value of its own; texts are
seen whole; labels that are null or have a null or unknown key are not used; different labels of one
document all count, rows of docs that share a labelled key count once as labelled; without labels of both classes every document gets the
share of good labels, or 1 without any; rows are scored one by one, so repeated
rows get equal scores; extra columns are ignored or kept, whatever their names; an empty table gives
an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, code_points, mix64, word_hashes, written

#: Labelled documents that a fit may use.
LABELLED = 8000
#: Rounds, steps of the fit in each, the probability from which a view is confident, and the share of labelled documents held out to calibrate.
ROUNDS, STEPS, CONFIDENT, HELD = 3, 2, 0.98, 0.25
#: The weight of a class's pseudo-labels together, in that of its labels; none weighs more than so many labels.
PSEUDO = 0.5
#: Rows of sums that reach the driver.
SUMS = 8
#: Below this probability of good quality a document is rejected.
REJECT = 0.5
_BUCKETS = 32
#: Hash buckets of words and of pairs of words, and the numbers before and after them in the text view.
_WORDS, _SHAPE = 64, 76

_SPACE, _BREAK, _LOWER, _UPPER, _DIGIT, _STOP, _SYMBOL, _OTHER = range(8)
_CLASS = np.full(257, _SYMBOL, dtype=np.int64)
for _c in range(256):
    _ch = chr(_c)
    _CLASS[_c] = _BREAK if _ch == "\n" else _SPACE if _ch.isspace() else _UPPER if _ch.isupper() else _LOWER if _ch.isalpha() else _DIGIT if _ch.isdigit() else _STOP if _ch in ".,;:'\"()?-" else _SYMBOL
_CLASS[256] = _OTHER


def text_view(text: str) -> np.ndarray:
    """What the text view sees: shares of pairs of character classes, repetition, the shape of words and lines, and shares of hashed words and pairs of words."""
    points = code_points(text)
    n = len(points)
    out = np.zeros(_SHAPE + 2 * _WORDS)
    if not n:
        out[_SHAPE - 1] = 1
        return out
    kinds = _CLASS[np.minimum(points, 256)]
    if n > 1:
        out[:64] = np.sqrt(np.bincount(kinds[:-1] * 8 + kinds[1:], minlength=64) / (n - 1))
    hashes = word_hashes(text)
    w = len(hashes)
    if w:
        out[_SHAPE : _SHAPE + _WORDS] = np.sqrt(np.bincount((mix64(hashes) % U64(_WORDS)).astype(np.int64), minlength=_WORDS) / w)
        if w > 1:
            with np.errstate(over="ignore"):
                pairs = mix64(hashes[:-1] * U64(0x9E3779B97F4A7C15) + hashes[1:])
            out[_SHAPE + _WORDS :] = np.sqrt(np.bincount((pairs % U64(_WORDS)).astype(np.int64), minlength=_WORDS) / (w - 1))
        counts = np.unique(hashes, return_counts=True)[1]
        lines = text.split("\n")
        top = counts.max() / w
        out[64:75] = (
            len(counts) / w, top, top > 0.3, (hashes[1:] == hashes[:-1]).sum() / w, (n - w) / w / 10, len(set(lines)) / len(lines), math.log1p(w) / 10,
            len(counts) / math.sqrt(w) / 10, (hashes[2:] == hashes[:-2]).sum() / w, math.log1p(n / len(lines)) / 10, (w < 5) * 1.0,
        )
    return out


def metadata_view(values: tuple, length: float | None) -> np.ndarray:
    """What the metadata view sees: the hashed values of each column, and the stated length."""
    out = np.zeros(_BUCKETS * len(values) + 2)
    for i, v in enumerate(values):
        out[_BUCKETS * i + xxhash.xxh3_64_intdigest(repr(v).encode("utf-8", "replace")) % _BUCKETS] = 1
    out[-2] = math.log1p(max(0.0, float(length))) / 10 if length is not None and math.isfinite(length) else 0
    out[-1] = length is None
    return out


def _newton(z: np.ndarray, target: np.ndarray, importance: np.ndarray, ridge: np.ndarray, start: np.ndarray, steps: int = 50) -> np.ndarray:
    """The weights of least logistic loss plus ridge times the squared distance from start; steps that don't lower it are halved."""
    def loss(w):
        odds = z @ w
        return float((importance * (np.logaddexp(0, odds) - target * odds)).sum() + 0.5 * (ridge * (w - start) ** 2).sum())

    w, now = start.copy(), loss(start)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (importance * (target - p)) - ridge * (w - start)
        step = np.linalg.solve((z * (importance * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ z + np.diag(ridge), slope)
        while (after := loss(w + step)) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        if after >= now:
            break
        done = after >= now - 1e-7 * abs(now)
        w, now = w + step, after
        if done:
            break
    return w


@dataclass
class Logistic:
    """A logistic classifier on standardised features, with Platt scaling of its log odds."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    @staticmethod
    def fitted(x: np.ndarray, y: np.ndarray) -> Logistic:
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale[scale < 1e-9] = 1
        out = Logistic(mean, scale, np.zeros(x.shape[1] + 1))
        return replace(out, weights=_newton(out.standard(x), y, np.ones(len(y)), out.ridge(), out.weights))

    def standard(self, x: np.ndarray) -> np.ndarray:
        """x in units of the deviations of what was first fitted to, and a constant."""
        return np.column_stack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones(len(x))])

    def ridge(self, penalty: float = 1.0) -> np.ndarray:
        out = np.full(len(self.weights), penalty)
        out[-1] = 1e-6
        return out

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Calibrated log odds."""
        return self.slope * (self.standard(x) @ self.weights) + self.shift

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        self.slope, self.shift = 1.0, 0.0
        z = self.odds(x)
        low, high = (1 / ((y == 0).sum() + 2), 1 - 1 / ((y == 1).sum() + 2))
        target = np.where(y == 1, high, low)
        a, b = _newton(np.column_stack([z, np.ones(len(z))]), target, np.ones(len(z)), np.array([1e-2, 1e-6]), np.array([1.0, 0.0]))
        self.slope, self.shift = max(a, 0.0), b


@dataclass
class Model:
    """Two calibrated views and the log odds of the prior; without views, a constant."""

    text: Logistic | None
    metadata: Logistic | None
    prior: float

    def odds(self, texts: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.text is None or self.metadata is None:
            flat = np.full(len(texts), self.prior)
            return flat, flat, flat
        t, m = self.text.odds(texts), self.metadata.odds(metadata)
        return t, m, t + m - self.prior


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


@dataclass
class Sums:
    """Of some rows: their weight, and the loss, its slope and its curvature at some weights of a classifier."""

    weight: float
    loss: float
    slope: np.ndarray
    curve: np.ndarray

    @staticmethod
    def of(z: np.ndarray, target: np.ndarray, weights: np.ndarray) -> Sums:
        odds = z @ weights
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        return Sums(float(len(z)), float((np.logaddexp(0, odds) - target * odds).sum()), z.T @ (target - p), (z * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ z)

    @staticmethod
    def none(n: int) -> Sums:
        return Sums(0.0, 0.0, np.zeros(n), np.zeros((n, n)))

    def plus(self, other: Sums, times: float = 1.0) -> Sums:
        return Sums(self.weight + times * other.weight, self.loss + times * other.loss, self.slope + times * other.slope, self.curve + times * other.curve)

    def packed(self) -> np.ndarray:
        return np.concatenate(([self.weight, self.loss], self.slope, self.curve[np.triu_indices(len(self.slope))]))

    @staticmethod
    def unpacked(x: np.ndarray, n: int) -> Sums:
        curve = np.zeros((n, n))
        curve[np.triu_indices(n)] = x[2 + n :]
        return Sums(float(x[0]), float(x[1]), x[2 : 2 + n], curve + np.triu(curve, 1).T)


#: What the pseudo-labels of a round add up to, for each view and class: of the classifiers that label, and of the weights of those that are fitted.
Passes = Callable[[tuple[Logistic, Logistic], tuple[np.ndarray, np.ndarray], float], list[list[Sums]]]


def pseudo_sums(views: tuple[np.ndarray, np.ndarray], models: tuple[Logistic, Logistic], weights: tuple[np.ndarray, np.ndarray], confident: float) -> list[list[Sums]]:
    """For each view the sums over the rows that the other view is sure of, by the class it gives them."""
    z = [m.standard(x) for m, x in zip(models, views, strict=True)]
    odds = [m.slope * (x @ m.weights) + m.shift for m, x in zip(models, z, strict=True)]
    out = []
    for v in (0, 1):
        chosen = [np.flatnonzero((odds[1 - v] if c else -odds[1 - v]) >= _logit(confident)) for c in (0, 1)]
        out.append([Sums.of(z[v][own], np.full(len(own), float(c)), weights[v]) for c, own in enumerate(chosen)])
    return out


def _learn(model: Logistic, labelled: tuple[np.ndarray, np.ndarray], weights: list[np.ndarray], best: list, sums: list[Sums]) -> None:
    """One step of a view's fit to its labels and pseudo-labels: weights[-1] gives way to better ones; best: loss and weights so far."""
    z, y = labelled
    whole = Sums.of(z, y, weights[-1])
    for c in (0, 1):
        if sums[c].weight:
            whole = whole.plus(sums[c], min(PSEUDO, PSEUDO * float((y == c).sum()) / sums[c].weight))
    ridge = model.ridge()
    loss = whole.loss + 0.5 * float((ridge * weights[-1] ** 2).sum())
    if best and loss > best[0]:
        weights.append((weights[-1] + best[1]) / 2)
        return
    best[:] = [loss, weights[-1]]
    weights.append(weights[-1] + np.linalg.solve(whole.curve + np.diag(ridge), whole.slope - ridge * weights[-1]))


def co_train(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, passes: Passes, rounds: int = ROUNDS, confident: float = CONFIDENT, held: float = HELD) -> Model:
    """The views' classifiers after rounds of exchange; passes goes over the documents without a label."""
    share = float(y.mean()) if len(y) else 1.0
    cut = max(1, int(len(y) * held))
    if len(y) < 8 or min(y[cut:].sum(), (1 - y[cut:]).sum(), y[:cut].sum(), (1 - y[:cut]).sum()) < 1:
        return Model(None, None, _logit(share))
    fit, check = slice(cut, None), slice(0, cut)
    models = [Logistic.fitted(view[fit], y[fit]) for view in views]
    labelled = [(m.standard(view[fit]), y[fit]) for m, view in zip(models, views, strict=True)]
    for turn in range(rounds + 1):
        for m, view in zip(models, views, strict=True):
            m.calibrate(view[check], y[check])
        if turn == rounds:
            break
        weights, best = [[m.weights] for m in models], [[], []]
        for step in range(STEPS + 1):
            sums = passes((models[0], models[1]), (weights[0][-1], weights[1][-1]), confident)
            for v in (0, 1):
                _learn(models[v], labelled[v], weights[v], best[v], sums[v])
        models = [replace(m, weights=b[1], slope=1.0, shift=0.0) for m, b in zip(models, best, strict=True)]
    # the prior of the documents that both views were calibrated on
    return Model(models[0], models[1], _logit((y[check].sum() + 1) / (cut + 2)))


def _number(docs: DataFrame, length: str):
    return (F.col(length).cast("double") if length in docs.columns else F.lit(None).cast("double")).alias("__n")


def _values(metadata: tuple[str, ...]):
    return F.struct(*(F.col(c).cast("string").alias(f"m{i}") for i, c in enumerate(metadata))).alias("__m")


def _both(texts: pa.Array, lengths: pa.Array, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The two views of some rows."""
    t = np.array([text_view(x or "") for x in texts.to_pylist()])
    m = np.array([metadata_view(tuple(v.values()), n) for n, v in zip(lengths.to_pylist(), values.to_pylist(), strict=True)])
    return t, m


def _slices(batches, rows: int = 500):
    for whole in batches:
        for begin in range(0, whole.num_rows, rows):
            yield whole.slice(begin, rows)


def seen(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", metadata: tuple[str, ...] = ("source", "lang"), length: str = "n_chars", labelled: int = LABELLED) -> DataFrame:
    """(id, y, t, m) in the shared folder: the views of every row of docs, and its label if it is of the sample; y is null otherwise."""
    known = labels.select(F.col(key).cast("string").alias("id"), F.col(label).cast("double").alias("y")).where("id IS NOT NULL AND y IN (0.0, 1.0)")
    known = F.broadcast(known.distinct().orderBy(F.xxhash64("id"), "id", "y").limit(labelled))  # at most so many rows
    rows = docs.select(F.col(key).cast("string").alias("id"), F.col(text).cast("string").alias("body"), _number(docs, length), _values(metadata))

    def see(batches):
        for b in _slices(batches):
            views = _both(*b.columns[2:])
            yield pa.RecordBatch.from_arrays([*b.columns[:2], *(pa.array([x.astype("<f4").tobytes() for x in v], pa.binary()) for v in views)], names=["id", "y", "t", "m"])

    return written(rows.join(known, "id", "left").select("id", "y", "body", "__n", "__m").mapInArrow(see, "id string, y double, t binary, m binary"), "views")


def _views(t: pa.Array, m: pa.Array, dims: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(b"".join(x.to_pylist()), dtype="<f4").reshape(-1, d).astype(np.float64) for x, d in ((t, dims[0]), (m, dims[1])))


def over_all(views: DataFrame, dims: tuple[int, int]) -> Passes:
    """passes for co_train() over a table of views."""
    rows = views.where("y IS NULL").select("t", "m")

    def passes(models, weights, confident):
        def add(batches):
            whole = None
            for b in _slices(batches, 4000):
                own = [s for view in pseudo_sums(_views(*b.columns, dims), models, weights, confident) for s in view]
                whole = own if whole is None else [a.plus(s) for a, s in zip(whole, own, strict=True)]
            if whole:
                task = TaskContext.get().partitionId() if TaskContext.get() else 0
                yield pa.RecordBatch.from_arrays([pa.array([task % SUMS], pa.int32()), pa.array([np.concatenate([s.packed() for s in whole]).tobytes()], pa.binary())], names=["to", "sums"])

        def add_up(batches):
            whole = None
            for b in batches:
                for raw in b.column(1):
                    one = np.frombuffer(raw.as_py(), dtype=np.float64)
                    whole = one.copy() if whole is None else whole + one
            if whole is not None:
                yield pa.RecordBatch.from_arrays([pa.array([whole.tobytes()], pa.binary())], names=["sums"])

        found = [np.frombuffer(r["sums"], dtype=np.float64) for r in rows.mapInArrow(add, "to int, sums binary").repartitionById(SUMS, "to").mapInArrow(add_up, "sums binary").collect()]
        n = [d + 1 for d in dims]
        if not found:
            return [[Sums.none(k)] * 2 for k in n]
        sizes = [2 + k + k * (k + 1) // 2 for k in n for _ in (0, 1)]
        parts = np.split(np.sum(found, axis=0), np.cumsum(sizes)[:-1])
        return [[Sums.unpacked(parts[2 * v + c], n[v]) for c in (0, 1)] for v in (0, 1)]

    return passes


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", metadata: tuple[str, ...] = ("source", "lang"), length: str = "n_chars", labelled: int = LABELLED, rounds: int = ROUNDS) -> Model:
    """A model fitted to a bounded sample of the labelled documents and to all others."""
    views = seen(docs, labels, key, text, label, metadata, length, labelled)
    dims = len(text_view("")), len(metadata_view(("",) * len(metadata), None))
    # one row for each label of the sample, however many rows of docs have its key
    one = views.where("y IS NOT NULL").groupBy("id", "y").agg(F.min(F.struct("t", "m")).alias("v")).select("id", "y", "v.t", "v.m")
    sample = sorted(one.collect(), key=lambda r: (xxhash.xxh3_64_intdigest(r["id"]), r["y"]))
    y = np.array([r["y"] for r in sample])
    own = _views(pa.array([r["t"] for r in sample], pa.binary()), pa.array([r["m"] for r in sample], pa.binary()), dims)
    return co_train(own, y, over_all(views, dims), rounds)


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", metadata: tuple[str, ...] = ("source", "lang"), length: str = "n_chars", reject: float = REJECT) -> DataFrame:
    """(key, p_text, p_metadata, p_good, keep) for every row of docs."""
    kind = docs.schema[key].dataType.simpleString()
    columns = docs.select(F.col(key), F.col(text).cast("string"), _number(docs, length), _values(metadata))

    def score(batches):
        for b in _slices(batches):
            p = _good(model, *b.columns[1:])
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x) for x in p), pa.array(p[2] >= reject)], names=[key, "p_text", "p_metadata", "p_good", "keep"])

    return columns.mapInArrow(score, f"{key} {kind}, p_text double, p_metadata double, p_good double, keep boolean")


def accepted(docs: DataFrame, model: Model, text: str = "text", metadata: tuple[str, ...] = ("source", "lang"), length: str = "n_chars", reject: float = REJECT) -> DataFrame:
    """The rows of docs that the model doesn't reject, with the columns of docs."""
    names, at = docs.columns, docs.columns.index(text)
    rows = docs.toDF(*(f"c{i}" for i in range(len(names))))  # the columns of docs may have any name
    own = {name: f"c{i}" for i, name in enumerate(names)}

    def choose(batches):
        for b in _slices(batches):
            keep = _good(model, b.column(at).cast(pa.string()), *b.columns[len(names) :])[2] >= reject
            yield pa.RecordBatch.from_arrays(b.columns[: len(names)], names=names).filter(pa.array(keep))

    return rows.select("*", _number(rows, own.get(length, length)), _values(tuple(own[c] for c in metadata))).mapInArrow(choose, docs.schema)


def _good(model: Model, texts: pa.Array, lengths: pa.Array, values: pa.Array) -> list[np.ndarray]:
    """The probabilities of good quality by text, by metadata and by both."""
    return [1 / (1 + np.exp(-np.clip(o, -30, 30))) for o in model.odds(*_both(texts, lengths, values))]
