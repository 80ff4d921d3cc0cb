"""Sinks. Writes go through Spark's committers, so a failed job leaves no half-written table."""

from __future__ import annotations

import json
import os
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import fixed
from ..operators import timeline
from ..schema import INVENTORY, feature_names


def sequences(df: DataFrame, path: str) -> None:
    """Frames or sequences by source; rows of one source are brought together first, so that it has few files."""
    df.repartition("source").write.mode("overwrite").partitionBy("source").parquet(path)


def inventory_jsonl(df: DataFrame, path: str) -> None:
    df.select(*sorted(df.columns)).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def inventory_csv(df: DataFrame, path: str) -> None:
    df.select(*(f.name for f in INVENTORY if f.name in df.columns)).write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def status_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def audit_csv(df: DataFrame, path: str) -> None:
    df.select(*sorted(df.columns)).write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def pass_list(df: DataFrame, path: str) -> None:
    """The ids of the passed videos, one to a line."""
    df.where("quality_passed").select("video_id").write.mode("overwrite").text(path)


def quality_csv(df: DataFrame, path: str, rate: str = "detection_rate") -> None:
    """Worst detection first, rates with four digits."""
    kinds = dict(df.dtypes)
    text = [fixed(F.col(c)).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in df.columns]
    df.orderBy(F.coalesce(rate, F.lit(0.0)), "video_id").select(*(F.when(F.col(c).isNotNull(), t).alias(c) for c, t in zip(df.columns, text, strict=True))).write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def group_stats_json(df: DataFrame, path: str, by: str = "grp") -> None:
    """One object for each group, with its classes as a list."""
    fields = [c for c in df.columns if c != by]
    df.groupBy(by).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("classes")).write.mode("overwrite").json(path)


def summary_json(counts: DataFrame, path: str) -> str:
    """The counts (field, value, n) of an inventory as one JSON document; there is a row for each value of a few fields."""
    out: dict = {}
    for r in counts.orderBy("field", "value").toLocalIterator():
        out.setdefault(r["field"], {})[r["value"]] = r["n"]
    with open(path, "w", encoding="utf-8") as f:
        json.dump(out, f, indent=2)
    return path


def manifest_json(records: DataFrame, path: str, **more: object) -> str:
    """An experiment's manifest as one JSON document on the driver: an experiment lists its files by name, so it is read whole by what it is for."""
    rows = [r.asDict(recursive=True) for r in records.orderBy("split", "video_id").toLocalIterator()]
    out: dict = {**more, "splits": {"train": [], "validation": [], "test": []}, "records": rows}
    for r in rows:
        out["splits"][r["split"]].append(r.get("path") or r["video_id"])
    if empty := [k for k, v in out["splits"].items() if not v]:
        raise ValueError(f"splits without records: {', '.join(empty)}")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(out, f, indent=2)
    return path


def frames_csv(frames: DataFrame, path: str, fps: float, names: list[str]) -> None:
    """A folder for each video with frame, time_sec, label, name and, with labels, true_label, true_name and correct."""
    name = lambda c: F.get(F.array(*(F.lit(n) for n in names)), F.col(c))
    out = [F.col("video_id"), F.col("frame"), fixed(F.col("frame") / F.lit(float(fps))).alias("time_sec"), F.col("pred").alias("label"), name("pred").alias("name")]
    if "label" in frames.columns:
        out += [F.col("label").alias("true_label"), name("label").alias("true_name"), (F.col("label") == F.col("pred")).cast("int").alias("correct")]
    frames.repartition("video_id").sortWithinPartitions("video_id", "frame").select(*out).write.mode("overwrite").partitionBy("video_id").option("header", True).csv(path)


def segments_json(frames: DataFrame, path: str, fps: float, label: str = "pred") -> None:
    """One object for each video with its runs and their times."""
    s = timeline.segments(frames, label)
    item = F.struct("seg_start", "seg_end", "label", (F.col("seg_start") / F.lit(float(fps))).alias("start_sec"), (F.col("seg_end") / F.lit(float(fps))).alias("end_sec"))
    s.groupBy("video_id").agg(F.lit(float(fps)).alias("fps"), F.max("seg_end").alias("num_frames"), F.sort_array(F.collect_list(item)).alias("segments")).write.mode("overwrite").json(path)


def _texts(df: DataFrame, path: str) -> None:
    """(video_id, value): a text file in a folder for each video."""
    df.repartition("video_id").write.mode("overwrite").partitionBy("video_id").text(path)


def annotation_text(intervals: DataFrame, path: str) -> None:
    """start;end;label;confidence; with four digits for each interval, drawn in so that it comes back on the same frames."""
    own = timeline.annotation_times(intervals).select("*", *(fixed(F.col(c)).alias(f"_{c}") for c in ("start_sec", "end_sec", "confidence")))
    line = F.concat("_start_sec", F.lit(";"), "_end_sec", F.lit(";"), F.col("label").cast("string"), F.lit(";"), "_confidence", F.lit(";"))
    rows = own.select("video_id", F.struct("start_sec", "end_sec", line.alias("line")).alias("x"))
    _texts(rows.groupBy("video_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["line"]), "\n").alias("value")), path)


def srt(intervals: DataFrame, path: str, names: list[str], confidence: bool = False) -> None:
    _texts(timeline.srt_text(timeline.srt_blocks(intervals, names, confidence)).select("video_id", F.regexp_replace("srt", "\n$", "").alias("value")), path)


def metrics_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def metrics_json(per_video: DataFrame, mean: DataFrame, path: str) -> None:
    """One object: the mean of each metric, and the metrics of every video in order of their ids."""
    every = per_video.agg(F.sort_array(F.collect_list(F.struct("video_id", *(c for c in per_video.columns if c != "video_id")))).alias("videos"))
    mean.select(F.struct(*mean.columns).alias("mean")).join(F.broadcast(every)).coalesce(1).write.mode("overwrite").json(path)


def stats_json(groups: DataFrame, classes: DataFrame, scenes: DataFrame, gaps: DataFrame, path: str, by: str = "grp") -> None:
    """One object for each group: its counts, its classes and scenes as lists, and the percentiles of its gaps."""
    listed = lambda df, name: df.groupBy(by).agg(F.sort_array(F.collect_list(F.struct(*(c for c in df.columns if c != by)))).alias(name))
    gap = gaps.select(by, F.struct(*(c for c in gaps.columns if c != by)).alias("gaps"))
    groups.join(listed(classes, "classes"), by, "left").join(listed(scenes, "scenes"), by, "left").join(gap, by, "left").write.mode("overwrite").json(path)


def arrays(frames: DataFrame, path: str, label: str = "pred", logits: str | None = None) -> None:
    """(video_id, prediction, logits): the predicted labels and scores of each video in order, as readers.predictions() reads them."""
    item = F.struct("frame", F.col(label).alias("p"), *([F.col(logits).alias("x")] if logits else []))
    whole = frames.groupBy("video_id").agg(F.sort_array(F.collect_list(item)).alias("rows"))
    field = lambda name: F.transform("rows", lambda r: r[name])
    whole.select("video_id", field("p").alias("prediction"), *([field("x").alias("logits")] if logits else [])).write.mode("overwrite").parquet(path)


def sequences_npz(sequences_: DataFrame, path: str, version: str) -> DataFrame:
    """Writes one NPZ record for each row (source, video_id, fps, features array<array<float>>, valid array<float>, labels array<int>?, further texts) as path/source/video_id.npz by the tasks themselves, and gives (video_id, file).

    path: a folder that all executors share. A file is written beside its place
    and renamed, so that no reader sees half of one.
    """
    names, columns = feature_names(), sequences_.columns
    plain = [c for c in columns if c not in ("features", "valid", "labels")]

    def write(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                folder = os.path.join(path, str(r["source"]))
                os.makedirs(folder, exist_ok=True)
                to = os.path.join(folder, f"{r['video_id']}.npz")
                more = {} if r.get("labels") is None else {"labels": np.asarray(r["labels"], dtype=np.int64)}
                x = np.stack([np.asarray(v, dtype=np.float32) for v in r["features"]], axis=1)
                temporary = f"{to}.{uuid.uuid4().hex}.tmp"
                with open(temporary, "wb") as f:
                    np.savez(f, features=x, valid_mask=np.asarray(r["valid"], dtype=np.float32), schema_version=version, feature_names=np.array(names), **more, **{c: r[c] for c in plain})
                os.replace(temporary, to)
                out.append((str(r["video_id"]), to))
            yield pd.DataFrame(out, columns=["video_id", "file"])

    return sequences_.mapInPandas(write, "video_id string, file string")


def prediction_marker(entries: DataFrame, path: str, model: str) -> None:
    """What marks an annotation as this engine's own."""
    entries.select("video_id", F.col("output_path").alias("annotation_path"), F.lit(model).alias("model_path"), F.current_timestamp().alias("written_at")).write.mode("append").json(path)


def mapping_text(names: list[str], path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(f"{i} {n}\n" for i, n in enumerate(names))


def timeline_strips(frames: DataFrame) -> DataFrame:
    """(video_id, strip, seg_start, seg_end, value): the rows of a timeline picture as runs: prediction, truth, tracking and errors."""
    own = frames.withColumn("_err", (F.col("pred") != F.col("label")).cast("int")).withColumn("_ok", (F.col("valid") > 0.5).cast("int"))
    strips = {"prediction": "pred", "truth": "label", "tracking": "_ok", "errors": "_err"}
    parts = [timeline.segments(own, c).select("video_id", F.lit(s).alias("strip"), "seg_start", "seg_end", F.col("label").alias("value")) for s, c in strips.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
