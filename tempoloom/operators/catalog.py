"""The catalogue of recordings: names, scenes, inventories, splits, manifests and fingerprints."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import hash_unit
from ..schema import BACKGROUND, NUM_CLASSES
from .ranks import ranked

ANNOTATION_FOLDER, ANNOTATION_FILE = "NOVA project", "gestures.annotation~"
OWN_SUFFIX = "_pred.mp4"


def normal_scene(scene: Column) -> Column:
    return F.replace(F.lower(F.trim(scene)), F.lit("_"), F.lit("-"))


def name_parts(name: Column) -> dict[str, Column]:
    """subject_id, gender, field3, scene_raw and name_error of a folder's name: its first four parts, none of them empty."""
    parts = F.split(name, "_", -1)
    good = (F.size(parts) >= 4) & ~F.array_contains(F.slice(parts, 1, 4), "")
    out = {k: F.when(good, F.get(parts, F.lit(i))) for i, k in enumerate(("subject_id", "gender", "field3", "scene_raw"))}
    return out | {"name_error": F.when(~good, F.lit("invalid_name"))}


def hand_side(name: Column) -> Column:
    """L or R where the third part of a name is one, in either case."""
    side = F.upper(F.get(F.split(name, "_", -1), F.lit(2)))
    return F.when(side.isin("L", "R"), side)


def taxonomy_frame(spark: SparkSession, taxonomy: dict) -> DataFrame:
    """(key, scene, polarity, category, hard_negative): one row for each exact name and alias, a small table from a file."""
    normal = lambda s: str(s).strip().lower().replace("_", "-")
    rows, exact = [], {normal(k): v for k, v in taxonomy.get("exact", {}).items()}
    for key, v in exact.items():
        if isinstance(v, str):
            rows.append((key, key, v, "posture" if v == "positive" else "confounder", v == "negative"))
        else:
            rows.append((key, normal(v.get("canonical", key)), v.get("polarity"), str(v.get("category", "unknown")), bool(v.get("hard_negative", False))))
    of = {r[0]: r for r in rows}
    aliases = {normal(a): normal(t) for a, t in taxonomy.get("aliases", {}).items()}
    rows = [r for r in rows if r[0] not in aliases] + [(a, *of[t][1:]) for a, t in aliases.items() if t in of]
    return spark.createDataFrame(rows, "key string, scene string, polarity string, category string, hard_negative boolean")


def resolved_scenes(rows: DataFrame, taxonomy: DataFrame, scene_raw: str = "scene_raw") -> DataFrame:
    """rows with scene, polarity, scene_category and hard_negative_eligible; a scene that isn't listed has none, and names are never guessed by prefix."""
    t = taxonomy.select(F.col("key").alias("_key"), F.col("scene"), F.col("polarity"), F.col("category").alias("_c"), F.col("hard_negative").alias("_h"))
    # Spark knows the size of a taxonomy made on the driver, and broadcasts it if it is small
    out = rows.join(t, normal_scene(F.col(scene_raw)) == F.col("_key"), "left")
    return out.withColumns({"scene_category": F.coalesce("_c", F.lit("unknown")), "hard_negative_eligible": F.coalesce("_h", F.lit(False))}).drop("_key", "_c", "_h")


def _file_columns(files: DataFrame, root: str) -> DataFrame:
    """files (path, length, modificationTime) below root with rel, dir, name."""
    clean = F.regexp_replace(F.col("path"), "^file:/*", "/")
    rel = F.substr(clean, F.lit(len(root.rstrip("/")) + 2))
    return files.select(F.col("length").alias("size"), F.col("modificationTime").alias("mtime"), rel.alias("rel")).withColumn("name", F.regexp_extract("rel", "([^/]*)$", 1)).withColumn("dir", F.regexp_replace("rel", "/?[^/]*$", ""))


def training_inventory(files: DataFrame, root: str, taxonomy: DataFrame, sources: list[str], version: int = 1) -> DataFrame:
    """A row for each folder of the sources that has a video or an annotation, or a name of four parts and some file below it.

    files: a binaryFile listing of root without contents. An empty folder has no
    file and so cannot be seen by a listing of files.
    """
    f = _file_columns(files, root).withColumn("source", F.get(F.split("rel", "/"), F.lit(0))).where(F.col("source").isin(sources))
    is_note = F.col("rel").endswith(f"{ANNOTATION_FOLDER}/{ANNOTATION_FILE}")
    notes = f.where(is_note).select("source", F.regexp_replace("dir", f"/?{ANNOTATION_FOLDER}$", "").alias("dir"), F.col("rel").alias("_note"))
    videos = f.where(F.lower("name").endswith(".mp4") & ~F.col("dir").endswith(ANNOTATION_FOLDER)).groupBy("source", "dir").agg(F.min(F.struct("name", "rel", "size", "mtime")).alias("_v"))
    # every folder above a file, from the source down
    parts = F.split("dir", "/")
    levels = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    above = f.select("source", F.explode(levels).alias("dir")).distinct()
    name = F.regexp_extract("dir", "([^/]*)$", 1)
    named = above.where((F.size(F.split(name, "_", -1)) >= 4) & (name != ANNOTATION_FOLDER))
    folders = named.unionByName(notes.select("source", "dir")).unionByName(videos.select("source", "dir")).distinct()
    rows = folders.join(notes, ["source", "dir"], "left").join(videos, ["source", "dir"], "left").withColumns(name_parts(F.regexp_extract("dir", "([^/]*)$", 1)))
    rows = resolved_scenes(rows, taxonomy)
    error = F.nullif(F.concat_ws(";", "name_error", F.when(F.col("_v").isNull(), "missing_mp4"), F.when(F.col("_note").isNull(), "missing_nova_annotation")), F.lit(""))
    at = lambda c: F.concat(F.lit(root.rstrip("/") + "/"), c)
    found = rows.select("source", F.replace("dir", F.lit("/"), F.lit("__")).alias("video_id"), at(F.col("dir")).alias("directory_path"), at(F.col("_v.rel")).alias("video_path"), at(F.col("_note")).alias("annotation_path"), "subject_id", "gender", "field3", "scene_raw", "scene", "polarity", F.when(error.isNull(), "ok").otherwise("error").alias("status"), "scene_category", "hard_negative_eligible", F.lit(version).alias("taxonomy_version"), F.col("_v.size").alias("video_size"), (F.unix_micros("_v.mtime") * 1000).alias("video_mtime_ns"), F.lit(None).cast("string").alias("annotation_sha256"), error.alias("error"))
    # a source without any file
    listed = files.sparkSession.createDataFrame([(s,) for s in sources], "source string")
    gone = listed.join(f.select("source").distinct(), "source", "left_anti")
    empty = {c: F.lit(None).cast(t) for c, t in found.dtypes}
    empty |= {"source": F.col("source"), "video_id": F.col("source"), "directory_path": at(F.col("source")), "status": F.lit("error"), "error": F.lit("missing_source"), "scene_category": F.lit("unknown"), "hard_negative_eligible": F.lit(False), "taxonomy_version": F.lit(version)}
    return found.unionByName(gone.select(*(v.alias(c) for c, v in empty.items())))


def inference_inventory(files: DataFrame, root: str, source: str = "inference") -> DataFrame:
    """A row for each recording: a folder with a single one, other than the root, is its sample, else folder/stem; own output is skipped."""
    f = _file_columns(files, root)
    notes = f.where(F.col("rel").endswith(f"{ANNOTATION_FOLDER}/{ANNOTATION_FILE}")).select(F.regexp_replace("dir", f"/?{ANNOTATION_FOLDER}$", "").alias("sample"), F.col("rel").alias("_note"))
    videos = f.where(F.lower("name").endswith(".mp4") & ~F.col("name").endswith(OWN_SUFFIX) & ~F.col("dir").endswith(ANNOTATION_FOLDER))
    alone = (F.count("*").over(Window.partitionBy("dir")) == 1) & (F.col("dir") != "")
    rows = videos.withColumn("alone", alone).withColumn("sample", F.when(F.col("alone"), F.col("dir")).otherwise(F.concat_ws("/", F.nullif("dir", F.lit("")), F.regexp_replace("name", r"\.[^.]*$", ""))))
    parts = name_parts(F.regexp_extract("sample", "([^/]*)$", 1))
    rows = rows.join(notes, "sample", "left").withColumns({k: F.when(F.col("alone"), v) for k, v in parts.items()})
    known = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unknown")).alias(c)
    at = lambda c: F.concat(F.lit(root.rstrip("/") + "/"), c)
    return rows.select(F.lit(source).alias("source"), F.concat_ws("__", F.lit(source), F.replace("sample", F.lit("/"), F.lit("__"))).alias("video_id"), at(F.col("sample")).alias("directory_path"), at(F.col("rel")).alias("video_path"), at(F.col("_note")).alias("annotation_path"), known("subject_id"), known("gender"), known("field3"), known("scene_raw"), F.lit("unknown").alias("scene"), F.lit("unknown").alias("polarity"), F.lit("ok").alias("status"), F.col("size").alias("video_size"), (F.unix_micros("mtime") * 1000).alias("video_mtime_ns"), F.col("name_error").alias("error"))


def _plain(part: Column) -> Column:
    """Text that can be a file's or folder's name."""
    return F.regexp_replace(part, r"[/\\]", "_")


def sequence_path(root: str, source: Column, video_id: Column) -> Column:
    """Where a sequence's record lies."""
    return F.concat(F.lit(root.rstrip("/") + "/"), _plain(source), F.lit("/"), _plain(video_id), F.lit(".npz"))


def track_path(root: str, source: Column, video_id: Column, fingerprint_: Column) -> Column:
    """Where a track's record lies: a folder for each way to track, so that tracks of other settings aren't found."""
    return F.concat(F.lit(root.rstrip("/") + "/"), fingerprint_, F.lit("/"), _plain(source), F.lit("/"), _plain(video_id), F.lit(".track.npz"))


def paired_recordings(entries: DataFrame, side: str | None = None) -> DataFrame:
    """Recordings with both a video and an annotation; of one hand side, those of unknown side included."""
    both = entries.where(F.col("video_path").isNotNull() & F.col("annotation_path").isNotNull())
    own = hand_side(F.regexp_extract("directory_path", "([^/]*)$", 1))
    return both if side is None else both.where(own.isNull() | (own == side))


def selected(entries: DataFrame, sources: list[str] | None = None, allow_unknown: bool = False, limit: int | None = None) -> DataFrame:
    """Entries of some sources and of known polarity, the first ``limit`` of each source by id."""
    out = entries.where(F.col("source").isin(sources)) if sources else entries
    if not allow_unknown:
        out = out.where(F.col("polarity").isin("positive", "negative"))
    if limit is None:
        return out
    if limit < 1:
        raise ValueError("the limit must be positive")
    rank = F.row_number().over(Window.partitionBy("source").orderBy("video_id"))
    return out.withColumn("_r", rank).where(F.col("_r") <= limit).drop("_r")


def ready(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("status").isin("ok", "ready"))


def inventory_summary(entries: DataFrame, fields: tuple[str, ...] = ("status", "source", "subject_id", "gender", "scene", "polarity")) -> DataFrame:
    """(field, value, n): counts by each field, unknown for none, in one pass; and of each error code."""
    value = lambda f: F.coalesce(F.nullif(F.col(f).cast("string"), F.lit("")), F.lit("unknown"))
    long = entries.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), value(f).alias("value")) for f in fields))).alias("x")).select("x.field", "x.value")
    codes = entries.select(F.lit("error").alias("field"), F.explode(F.split("error", ";")).alias("value")).where("value <> ''") if "error" in entries.columns else long.limit(0)
    return long.unionByName(codes).groupBy("field", "value").agg(F.count("*").alias("n"))


def label_interval_counts(intervals: DataFrame) -> DataFrame:
    return intervals.groupBy("label").agg(F.count("*").alias("n"))


def status_summary(rows: DataFrame, status: str = "status") -> DataFrame:
    return rows.groupBy(F.coalesce(F.col(status), F.lit("unknown")).alias("status")).agg(F.count("*").alias("n"))


def with_state(entries: DataFrame, present: DataFrame, missing: str = "missing_track") -> DataFrame:
    """entries with status missing where (source, video_id) is not among present."""
    seen = present.select("source", "video_id", F.lit(True).alias("_in")).distinct()
    return entries.join(seen, ["source", "video_id"], "left").withColumn("status", F.when(F.col("_in").isNull(), missing).otherwise(F.col("status"))).drop("_in")


def stale(entries: DataFrame, stored: DataFrame, fingerprint: str = "fingerprint") -> DataFrame:
    """The entries whose fingerprint differs from that of the stored record of the same id, or that have none."""
    old = stored.select("video_id", F.col(fingerprint).alias("_old"))
    return entries.join(old, "video_id", "left").where(~F.col(fingerprint).eqNullSafe(F.col("_old"))).drop("_old")


def own_annotations_forgotten(entries: DataFrame, markers: DataFrame) -> DataFrame:
    """entries without the path of an annotation that this engine wrote itself; markers: (annotation_path)."""
    own = markers.select("annotation_path", F.lit(True).alias("_own")).distinct()
    return entries.join(own, "annotation_path", "left").withColumn("annotation_path", F.when(F.col("_own").isNull(), F.col("annotation_path"))).drop("_own")


def annotation_output(entries: DataFrame, overwrite: bool = False) -> DataFrame:
    """entries with output_path and shadowed: beside an annotation by hand, the output gets a name of its own."""
    target = F.concat(F.col("directory_path"), F.lit(f"/{ANNOTATION_FOLDER}/{ANNOTATION_FILE}"))
    by_hand = F.col("annotation_path").isNotNull() & F.lit(not overwrite)
    return entries.withColumn("output_path", F.when(by_hand, F.replace(target, F.lit(".annotation~"), F.lit(".pred.annotation~"))).otherwise(target)).withColumn("shadowed", by_hand)


def incompatible(records: DataFrame, fingerprints: list[str]) -> DataFrame:
    """The records whose preprocessing is not one that a model was trained on."""
    if not fingerprints:
        raise ValueError("the model states no preprocessing")
    own = F.coalesce("preprocess_config_fingerprint", "preprocess_fingerprint")
    return records.where(own.isNull() | ~own.isin(fingerprints))


def fingerprint(config: dict, without: tuple[str, ...] = ()) -> str:
    """The first 16 hex digits of the sha256 of a config as canonical JSON, without what only concerns a run."""
    text = json.dumps({k: v for k, v in config.items() if k not in without}, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def row_fingerprint(*parts: Column) -> Column:
    """The same over the parts of a row, each with its length before it, so that no two rows are put together alike."""
    text = F.concat(*(F.coalesce(F.concat(F.length(p.cast("string")), F.lit(":"), p.cast("string")), F.lit("-")) for p in parts))
    return F.substring(F.sha2(text, 256), 1, 16)


def without_dirty(rows: DataFrame, dirty: DataFrame) -> DataFrame:
    return rows.join(dirty.select("video_id").distinct(), "video_id", "left_anti")


def excluded(rows: DataFrame, dirty: DataFrame) -> DataFrame:
    return rows.join(dirty.select("video_id").distinct(), "video_id", "left_semi")


Ratios = tuple[float, float, float]


def _checked(ratios: Ratios) -> Ratios:
    if any(not 0 < r < 1 for r in ratios) or abs(sum(ratios) - 1) > 1e-9:
        raise ValueError("the ratios must be between 0 and 1 and add up to 1")
    return ratios


def _named(train: Column, validation: Column, what: str) -> Column:
    """The split's name where the conditions say so; an error for fewer than three rows, as each split needs one."""
    few = F.raise_error(F.lit(f"three {what} are needed at least")).cast("string")
    return F.when(F.col("_all") < 3, few).when(train, "train").when(validation, "validation").otherwise("test")


def hashed_splits(rows: DataFrame, key: str, ratios: Ratios, seed: int = 0) -> DataFrame:
    """(key, split) of subjects or videos: the first ranks in hash order train, the next validate, so each split has its exact count, one at least."""
    _checked(ratios)
    keys = rows.select(key).where(F.col(key).isNotNull()).distinct()
    n = F.col("_all")
    train, val = (F.greatest(F.lit(1), F.bround(n * r)) for r in ratios[:2])
    full = train + val >= n
    train, val = F.when(full, n - 2).otherwise(train), F.when(full, 1).otherwise(val)
    rank = F.col("_rank")
    return ranked(keys, hash_unit(F.lit(seed), key), key).select(key, _named(rank <= train, rank <= train + val, f"values of {key}").alias("split"))


def registered_splits(rows: DataFrame, key: str, registry: DataFrame) -> DataFrame:
    """(key, split) by a registry (key, split), so that experiments stay comparable; a key that it lacks is an error."""
    both = rows.select(key).where(F.col(key).isNotNull()).distinct().join(registry.select(key, "split"), key, "left")
    missing = F.raise_error(F.concat(F.lit(f"the registry lacks {key} "), F.col(key).cast("string"))).cast("string")
    return both.select(key, F.when(F.col("split").isNull(), missing).otherwise(F.col("split")).alias("split"))


def grouped_splits(rows: DataFrame, group: str, ratios: Ratios, seed: int = 0) -> DataFrame:
    """(group, split): whole groups of rows. Groups lie side by side in hash order, each as long as it has rows, and the split is the one in whose share of that line a group's middle lies; the first trains, the last two validate and test in any case."""
    _checked(ratios)
    sizes = rows.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("_rows"))
    middle = (F.col("_sum") - F.col("_rows") / 2) / F.col("_total")
    first, left = F.col("_rank") == 1, F.col("_all") - F.col("_rank")
    train = first | ((left > 1) & (middle < ratios[0]))
    return ranked(sizes, hash_unit(F.lit(seed), group), group, weight="_rows").select(group, _named(train, (left == 1) | ((left > 1) & (middle < ratios[0] + ratios[1])), f"values of {group}").alias("split"))


def manifest_records(rows: DataFrame, splits: DataFrame, dirty: DataFrame, sources: list[str] = (), scenes: list[str] = (), polarities: list[str] = (), train_sources: list[str] = (), test_sources: list[str] = ()) -> DataFrame:
    """The records of an experiment: passed, of known subject, not dirty, of the wanted kinds, with their subject's split.

    splits: (subject_id, split), one row for each subject; a subject without one is an error.
    """
    good = rows.where(F.col("quality_passed") & F.coalesce(F.col("subject_id") != "", F.lit(False)))
    for column, wanted in (("source", sources), ("scene", scenes), ("polarity", polarities)):
        if wanted:
            good = good.where(F.col(column).isin(list(wanted)))
    missing = F.raise_error(F.concat(F.lit("no split for subject "), F.col("subject_id"))).cast("string")
    out = without_dirty(good, dirty).join(splits, "subject_id", "left").withColumn("split", F.when(F.col("split").isNull(), missing).otherwise(F.col("split")))
    if train_sources:
        out = out.where((F.col("split") == "test") | F.col("source").isin(list(train_sources)))
    if test_sources:
        out = out.where((F.col("split") != "test") | F.col("source").isin(list(test_sources)))
    return out


def leaks(records: DataFrame) -> DataFrame:
    """(video_id, n) of the videos that occur more than once, in one split or in several."""
    return records.groupBy("video_id").agg(F.count("*").alias("n")).where("n > 1")


def class_weights(frames: DataFrame, max_ratio: float = 50.0, classes: int = NUM_CLASSES, label: str = "label") -> DataFrame:
    """(class_id, weight): inverse frequencies, none above max_ratio times the least; a class that does not occur has that ceiling, and all have 1 if none occurs."""
    if max_ratio < 1:
        raise ValueError("the largest ratio must be 1 at least")
    n = frames.groupBy(F.col(label).alias("class_id")).agg(F.count("*").alias("n"))
    dim = frames.sparkSession.range(classes).select(F.col("id").cast("int").alias("class_id")).join(n, "class_id", "left")
    whole = Window.partitionBy(F.lit(1))  # a row for each class
    raw = F.sum("n").over(whole) / (F.count("n").over(whole) * F.col("n"))
    least = dim.withColumn("raw", raw).withColumn("top", F.min("raw").over(whole) * max_ratio)
    return least.select("class_id", F.coalesce(F.least("raw", "top"), F.col("top"), F.lit(1.0)).alias("weight"))


def smoothness(frames: DataFrame, log_p: str = "log_p", clamp: float = 16.0, valid: str = "valid") -> DataFrame:
    """(tmse): the mean over adjacent valid frames and classes of the squared change of the log probability, cut at the clamp."""
    order = Window.partitionBy("video_id").orderBy("frame")
    before, was = F.lag(log_p).over(order), F.lag(valid).over(order)
    cut = F.aggregate(F.zip_with(F.col(log_p), before, lambda a, b: F.least((a - b) * (a - b), F.lit(clamp)).cast("double")), F.lit(0.0), lambda s, x: s + x)
    rows = frames.withColumn("_t", F.when((F.col(valid) > 0.5) & (was > 0.5), cut)).withColumn("_n", F.when(F.col("_t").isNotNull(), F.size(log_p)))
    return rows.agg((F.sum("_t") / F.sum("_n")).alias("tmse"))


def conflicts(frames: DataFrame, entries: DataFrame) -> DataFrame:
    """(video_id): negative scenes that have an action label."""
    acted = frames.where(F.col("label") != BACKGROUND).select("video_id").distinct()
    return entries.where(F.col("polarity") == "negative").select("video_id").join(acted, "video_id", "left_semi")
