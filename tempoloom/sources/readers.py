"""Sources: annotations, lists, inventories, NPZ records, manifests, taxonomies and listings."""

from __future__ import annotations

import io
import json

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import BACKGROUND, COORDS, INVENTORY, NUM_CLASSES, feature_names


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modificationTime) of all files below root, without their contents."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).drop("content")


def _lines(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """(path, line_no from 1, line) of small text files, each read whole so that lines keep their numbers."""
    reader = spark.read.option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    whole = reader.text(path, wholetext=True).select(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("path"), F.posexplode(F.split(F.regexp_replace("value", "^\\uFEFF", ""), "\r\n|\n|\r")).alias("n", "line"))
    return whole.select("path", (F.col("n") + 1).alias("line_no"), F.trim("line").alias("line"))


def annotations(spark: SparkSession, path: str | list[str], pattern: str | None = None, strict: bool = True) -> DataFrame:
    """(path, line_no, start_sec, end_sec, label, confidence[, error]): lines of start;end;label[;confidence].

    -1 is the background. Strict: any bad line raises with its file and number;
    otherwise it has an error and the others stay.
    """
    lines = _lines(spark, path, pattern).where("line <> ''")
    parts = lines.withColumn("p", F.filter(F.transform(F.split("line", ";"), lambda x: F.trim(x)), lambda x: x != ""))
    number = lambda i: F.get("p", F.lit(i)).try_cast("double")
    raw = F.get("p", F.lit(2)).try_cast("int")
    label = F.when(raw == -1, BACKGROUND).otherwise(raw)
    rows = parts.select("path", "line_no", number(0).alias("start_sec"), number(1).alias("end_sec"), label.alias("label"), F.when(F.size("p") > 3, number(3)).otherwise(1.0).alias("confidence"), F.size("p").alias("_n"))
    bad = F.when(F.col("_n") < 3, "expected at least 3 fields").when(F.col("start_sec").isNull() | F.col("end_sec").isNull() | F.col("label").isNull() | F.col("confidence").isNull(), "has invalid fields").when(~F.col("label").between(0, NUM_CLASSES - 1), "has an unsupported label").when(F.col("end_sec") < F.col("start_sec"), "ends before it starts")
    rows = rows.withColumn("error", bad).drop("_n")
    if not strict:
        return rows
    message = F.concat("path", F.lit(":"), F.col("line_no").cast("string"), F.lit(" "), F.col("error"))
    return rows.withColumn("label", F.when(F.col("error").isNotNull(), F.raise_error(message).cast("int")).otherwise(F.col("label"))).drop("error")


def annotation_errors(rows: DataFrame) -> DataFrame:
    """(path, bad_lines) of the files that a lenient read found faulty."""
    return rows.where("error IS NOT NULL").groupBy("path").agg(F.count("*").alias("bad_lines"))


def dirty_list(spark: SparkSession, path: str) -> DataFrame:
    """(video_id): lines of source/sample with either slash; blank lines and # comments are skipped, bad lines raise with all their numbers."""
    lines = _lines(spark, path).where("line <> '' AND NOT startswith(line, '#')")
    parts = lines.withColumn("p", F.transform(F.split(F.replace("line", F.lit("\\"), F.lit("/")), "/"), lambda x: F.trim(x)))
    good = (F.size("p") >= 2) & ~F.array_contains("p", "")
    # one file, checked as a whole: the list of its bad lines
    bad = [r[0] for r in parts.where(~good).select("line_no").orderBy("line_no").collect()]
    if bad:
        raise ValueError(f"{path}: not a source/sample path in lines {', '.join(map(str, bad))}")
    return parts.select(F.array_join("p", "__").alias("video_id")).distinct()


def class_mapping(spark: SparkSession, path: str, expected: list[str] | None = None) -> DataFrame:
    """(class_id, class_name) of lines "id name", which have to be the expected ones."""
    parts = _lines(spark, path).where("line <> ''").select(F.split("line", r"\s+", 2).alias("p")).select(F.get("p", F.lit(0)).cast("int").alias("class_id"), F.get("p", F.lit(1)).alias("class_name"))
    if expected is not None and [tuple(r) for r in parts.orderBy("class_id").collect()] != list(enumerate(expected)):
        raise ValueError(f"{path}: not the expected classes")
    return parts


def taxonomy(path: str) -> dict:
    """A scene taxonomy from YAML or JSON, with mappings 'exact' and 'aliases'."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        out = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as e:
            raise ImportError("a YAML taxonomy needs PyYAML; give it as JSON instead") from e
        out = yaml.safe_load(text)
    if not isinstance(out, dict) or not isinstance(out.get("exact"), dict) or not isinstance(out.get("aliases"), dict):
        raise ValueError(f"{path}: a taxonomy needs mappings 'exact' and 'aliases'")
    return out


def config(path: str, *required: str) -> dict:
    """A config from YAML or JSON: a mapping whose required entries are mappings, too."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        out = json.loads(text)
    else:
        import yaml

        out = yaml.safe_load(text)
    if not isinstance(out, dict):
        raise ValueError(f"{path}: not a mapping")
    if bad := [k for k in required if not isinstance(out.get(k), dict)]:
        raise ValueError(f"{path}: no mappings {', '.join(bad)}")
    return out


def inputs(spark: SparkSession, paths: list[str], manifest_path: str | None = None, split: str = "test") -> DataFrame:
    """(path) of what to read: those given, else the files of a manifest's split."""
    if paths:
        return spark.createDataFrame([(p,) for p in paths], "path string")
    if not manifest_path:
        raise ValueError("neither paths nor a manifest")
    return manifest(spark, manifest_path).where(F.col("split") == split).select("path")


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, length, modificationTime) of the files below root; a root that can't be listed gives one row with an error instead of failing."""
    kinds = "path string, modificationTime timestamp, length long, error string"
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    except AnalysisException as e:
        reason = io_error(e.getCondition() or "unknown")
        return spark.createDataFrame([(root, None, None, reason)], kinds)
    return found.select("path", "modificationTime", "length", F.lit(None).cast("string").alias("error"))


def io_error(reason: str) -> str:
    """The code of an error of the file system; semicolons part codes, so none may be inside."""
    return "io_error:" + reason.replace(";", ",")


def sequence_sources(files: DataFrame, root: str) -> DataFrame:
    """(source, path) of the NPZ records in the folders right below root; the loose ones of root itself, under its own name, where there are no others."""
    clean = F.regexp_replace(F.col("path"), "^file:/*", "/")
    top = root.rstrip("/")
    parts = F.split(F.substr(clean, F.lit(len(top) + 2)), "/")
    own = files.where(F.col("path").endswith(".npz")).select(F.when(F.size(parts) == 2, F.get(parts, F.lit(0))).alias("source"), "path", F.size(parts).alias("depth")).where("depth <= 2")
    below = own.where("depth = 2").select("source", "path")
    loose = own.where("depth = 1").join(F.broadcast(below.limit(1).select(F.lit(1).alias("any"))), F.lit(True), "left_anti")
    return below.unionByName(loose.select(F.lit(top.rsplit("/", 1)[-1]).alias("source"), "path"))


def predictions(spark: SparkSession, files: DataFrame, marker: str = "predictions.json") -> DataFrame:
    """(video_id, prediction, logits?) of the latest run: the table prediction.parquet beside its marker."""
    run = latest_run(files, marker).first()["run"]
    if run is None:
        raise FileNotFoundError(f"no run has {marker}")
    return spark.read.parquet(f"{run}/prediction.parquet")


def inventory_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INVENTORY).json(path)


def inventory_csv(spark: SparkSession, path: str) -> DataFrame:
    """The inventory with its types; the columns are found by name, empty fields are null."""
    raw = spark.read.option("header", True).option("nullValue", "").option("multiLine", True).csv(path)
    return raw.select(*((F.col(f.name).try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in INVENTORY))


def audit_csv(spark: SparkSession, path: str, flags: tuple[str, ...] = ("quality_passed", "hard_negative_eligible")) -> DataFrame:
    raw = spark.read.option("header", True).option("nullValue", "").csv(path)
    return raw.withColumns({c: F.coalesce(F.lower(c) == "true", F.lit(False)) for c in flags if c in raw.columns})


def status_jsonl(spark: SparkSession, path: str) -> DataFrame:
    from ..schema import STATUS

    return spark.read.schema(STATUS).json(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(split, path) of the files of an experiment's splits."""
    return spark.read.schema("splits map<string, array<string>>").option("multiLine", True).json(path).select(F.explode("splits").alias("split", "paths")).select("split", F.explode("paths").alias("path"))


def checked_manifest(records: DataFrame, files: DataFrame) -> DataFrame:
    """The rows (split, path) of a manifest, of which each has to be among files (path)."""
    there = files.select(F.regexp_replace("path", "^file:/*", "/").alias("path"), F.lit(True).alias("_there")).distinct()
    missing = F.raise_error(F.concat(F.lit("a manifest's file is missing: "), F.col("path"))).cast("string")
    own = records.withColumn("path", F.regexp_replace("path", "^file:/*", "/"))
    return own.join(there, "path", "left").select("split", F.when(F.col("_there"), F.col("path")).otherwise(missing).alias("path"))


def latest_run(files: DataFrame, marker: str = "predictions.json") -> DataFrame:
    """(run): the last folder, by name, that has the marker file."""
    folder = F.regexp_extract("path", f"^(.*)/{marker}$", 1)
    return files.where(F.col("path").endswith("/" + marker)).agg(F.max(folder).alias("run"))


def _npz(batches, read):
    for pdf in batches:
        yield from (read(p, np.load(io.BytesIO(c), allow_pickle=False)) for p, c in zip(pdf["path"], pdf["content"], strict=True))


def sequences_npz(spark: SparkSession, path: str, version: str | None = None, pattern: str = "*.npz") -> DataFrame:
    """(video_id, frame, label, valid, features, fps, source, subject_id, scene, polarity): the frames of NPZ sequence records.

    version: the schema version that records need to have. Strings inside have to
    be plain arrays; pickled objects are refused.
    """
    names = feature_names()

    def read(path, z):
        if version and str(z["schema_version"]) != version:
            raise ValueError(f"{path}: schema {z['schema_version']}, not {version}")
        if "feature_names" in z.files and z["feature_names"].tolist() != names:
            raise ValueError(f"{path}: other features")
        x = z["features"]
        n = x.shape[1]
        text = lambda k, default: str(z[k]) if k in z.files else default
        label = z["labels"].astype("int64").tolist() if "labels" in z.files else [None] * n
        return pd.DataFrame({"video_id": text("video_id", ""), "frame": np.arange(n, dtype="int32"), "label": pd.array(label, dtype="Int32"), "valid": z["valid_mask"].astype("float32"), "features": list(x.T.astype("float32")), "fps": float(z["fps"]), "source": text("source", ""), "subject_id": text("subject_id", ""), "scene": text("scene", "unknown"), "polarity": text("polarity", "unknown")})

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "content")
    return raw.mapInPandas(lambda b: _npz(b, read), "video_id string, frame int, label int, valid float, features array<float>, fps double, source string, subject_id string, scene string, polarity string")


def tracks_npz(spark: SparkSession, path: str, pattern: str = "*.npz") -> DataFrame:
    """(path, frame, landmarks, tracking_quality, valid_mask, hand_side, source_fps, metadata_json) of NPZ tracks.

    A track without sides has the configured hand wherever it is valid.
    """

    def read(path, z):
        valid = z["valid_mask"].astype("float32")
        meta = str(z["metadata_json"])
        own = -1 if str(json.loads(meta).get("physical_hand", "right")).lower() == "left" else 1
        side = z["hand_side"] if "hand_side" in z.files else np.where(valid > 0.5, own, 0)
        return pd.DataFrame({"path": path, "frame": np.arange(len(valid), dtype="int32"), "landmarks": list(z["landmarks"].reshape(len(valid), COORDS).astype("float32")), "tracking_quality": z["tracking_quality"].astype("float32"), "valid_mask": valid, "hand_side": side.astype("int8"), "source_fps": float(z["source_fps"]), "metadata_json": meta})

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "content")
    return raw.mapInPandas(lambda b: _npz(b, read), "path string, frame int, landmarks array<float>, tracking_quality float, valid_mask float, hand_side byte, source_fps double, metadata_json string")


def sequence_headers_npz(spark: SparkSession, path: str, pattern: str = "*.npz") -> DataFrame:
    """(video_id, num_frames, labelled, valid_ratio, fps, source, subject_id, scene, polarity) of NPZ records, whose features are not unpacked."""

    def read(path, z):
        text = lambda k, default: str(z[k]) if k in z.files else default
        valid = z["valid_mask"]
        return pd.DataFrame({"video_id": [text("video_id", "")], "num_frames": [len(valid)], "labelled": ["labels" in z.files], "valid_ratio": [float((valid > 0.5).mean()) if len(valid) else 0.0], "fps": [float(z["fps"])], "source": [text("source", "")], "subject_id": [text("subject_id", "")], "scene": [text("scene", "unknown")], "polarity": [text("polarity", "unknown")]})

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "content")
    return raw.mapInPandas(lambda b: _npz(b, read), "video_id string, num_frames int, labelled boolean, valid_ratio double, fps double, source string, subject_id string, scene string, polarity string")


def mock_frames(spark: SparkSession, videos: int, frames: int = 200, fps: float = 15.0, miss: float = 0.08, seed: int = 0) -> DataFrame:
    """(video_id, frame, label, valid, quality, coords): made-up sequences of random runs about a second long, half of them background; each class has a posture of its own, between which the hand drifts. One seed for each video."""

    def make(batches):
        postures = np.random.default_rng(seed).normal(0, 0.3, (NUM_CLASSES, COORDS))
        for pdf in batches:
            for v in pdf["id"]:
                rng = np.random.default_rng([seed, int(v)])
                lengths = 3 + rng.poisson(fps, frames // 3 + 1)
                classes = np.where(rng.random(len(lengths)) < 0.5, BACKGROUND, rng.integers(0, NUM_CLASSES, len(lengths)))
                label = np.repeat(classes, lengths)[:frames]
                steps = np.exp(-np.arange(12) / 3)
                target = postures[label]
                coords = np.stack([np.convolve(c, steps / steps.sum())[:frames] for c in target.T], axis=1) + rng.normal(0, 0.02, (frames, COORDS))
                valid = rng.random(frames) >= miss
                held = np.maximum.accumulate(np.where(valid, np.arange(frames), 0))
                yield pd.DataFrame({"video_id": f"mock_{v}", "frame": np.arange(frames, dtype="int32"), "label": label.astype("int32"), "valid": valid.astype("int32"), "quality": valid * rng.uniform(0.6, 1.0, frames), "coords": list(coords[held])})

    return spark.range(videos).mapInPandas(make, "video_id string, frame int, label int, valid int, quality double, coords array<double>")


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with the columns and types of schema, nulls for what it lacks."""
    return df.select(*((F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)$", 1)
