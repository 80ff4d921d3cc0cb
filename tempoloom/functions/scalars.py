"""Column functions that the operators share."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import BACKGROUND


def hash_unit(*columns: Column | str) -> Column:
    """A number in [0, 1) that depends on the values alone, the same on any partitioning."""
    text = F.concat_ws("|", *(F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def fixed(number: Column, digits: int = 4) -> Column:
    """A number as text with so many digits, rounded by its exact binary value as C does, where format_string() rounds the decimal one half up. Null for null."""

    @F.pandas_udf("string")
    def text(x: pd.Series) -> pd.Series:
        return x.map(lambda v: None if v is None or v != v else f"{v:.{digits}f}")

    return text(number.cast("double"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null where whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def iou(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Intersection over union of [a0, a1) and [b0, b1); 0 for an empty union."""
    both = F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))
    return F.coalesce(ratio(both, (a1 - a0) + (b1 - b0) - both), F.lit(0.0))


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    """1 where nothing was there or found, else the harmonic mean of precision and recall."""
    return F.when(tp + fp + fn == 0, 1.0).when(tp == 0, 0.0).otherwise(2.0 * tp / (2.0 * tp + fp + fn))


def hamming(position: Column, length: int) -> Column:
    return F.lit(1.0) if length <= 1 else F.lit(0.54) - F.lit(0.46) * F.cos(2 * F.pi() * position / (length - 1))


def softmax(scores: Column) -> Column:
    shifted = F.transform(scores, lambda x: F.exp(x.cast("double") - F.array_max(scores).cast("double")))
    return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b))


def first_argmax(scores: Column) -> Column:
    """The index of the largest entry, the first of equal ones."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def masked_argmax(scores: Column, allowed: list[int]) -> Column:
    """first_argmax over the allowed classes; over all if none is given."""
    if not allowed:
        return first_argmax(scores)
    ids = F.array(*(F.lit(i) for i in allowed))
    return first_argmax(F.transform(scores, lambda x, i: F.when(F.array_contains(ids, i), x.cast("double")).otherwise(F.lit(float("-inf")))))


def resolve_class_ids(classes: list, names: list[str], background: int = BACKGROUND) -> list[int]:
    """Sorted ids of classes given by id or name, with the background if there are any."""
    out = set()
    for c in classes:
        if isinstance(c, bool):
            raise ValueError("a class is an id or a name, not a truth value")
        n = names.index(c) if isinstance(c, str) and c in names else c
        if not isinstance(n, int) or not 0 <= n < len(names):
            raise ValueError(f"unknown class: {c}")
        out.add(n)
    return sorted(out | {background}) if out else []


def timestamp_text(seconds: Column) -> Column:
    """HH:MM:SS,mmm; negative times are 0, halves of a millisecond go to the even one."""
    ms = F.bround(F.greatest(seconds, F.lit(0.0)) * 1000).cast("long")
    part = lambda x, n: F.lpad(x.cast("string"), n, "0")
    hours = F.floor(ms / 3600000)
    return F.concat(F.when(hours < 10, F.concat(F.lit("0"), hours.cast("string"))).otherwise(hours.cast("string")), F.lit(":"), part(F.floor(ms / 60000) % 60, 2), F.lit(":"), part(F.floor(ms / 1000) % 60, 2), F.lit(","), part(ms % 1000, 3))


def quantised(start: Column, end: Column) -> tuple[Column, Column]:
    """A time interval drawn in by 0.1 ms and put on that grid, so that it falls back on the same frames; a point if nothing is left."""
    s, e = F.ceil((start + 1e-4) * 1e4) / 1e4, F.floor((end - 1e-4) * 1e4) / 1e4
    point = F.floor(end * 1e4) / 1e4
    return F.when(e < s, point).otherwise(s), F.when(e < s, point).otherwise(e)


def linspace_int(low: Column, high: Column, i: Column, n: int) -> Column:
    """The i-th of n whole numbers spread over low..high, fractions cut off."""
    return low.cast("int") if n <= 1 else (low + (high - low) * i / F.lit(float(n - 1))).cast("int")


def class_name(class_id: Column, names: list[str]) -> Column:
    """The name of a class; an id out of range is an error."""
    bad = F.raise_error(F.concat(F.lit("no such class: "), class_id.cast("string")))
    return F.when(class_id.between(0, len(names) - 1), F.get(F.array(*(F.lit(n) for n in names)), class_id)).otherwise(bad)
