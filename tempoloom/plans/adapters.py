"""Views that give the driver's tables the shapes of the sequence model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, frame, label, pred, valid, value): the events of a user as a timeline."""
    e = table(spark, sf_dir, "events")
    frame = (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).cast("int")
    label = F.when(F.col("event_type") == "click", 0).when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "signup", 2).otherwise(14)
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    b = e.select(F.col("user_id").alias("video_id"), frame.alias("frame"), label.alias("label"), k.alias("k"), "value")
    pred = F.when(F.col("k") % 7 == 0, 14).when(F.col("k") % 11 == 0, (F.col("label") + 1) % 3).otherwise(F.col("label"))
    return b.select("video_id", "frame", "label", pred.cast("int").alias("pred"), F.when(F.col("value") >= 5, 1).otherwise(0).alias("valid"), "value")


def conversation_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, frame, label): the turns of a conversation, by role."""
    c = table(spark, sf_dir, "conversations")
    frame = (F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1).cast("int")
    return c.select(F.col("conv_id").alias("video_id"), frame.alias("frame"), F.when(F.col("role") == "user", 0).when(F.col("role") == "assistant", 1).otherwise(14).alias("label"))


def document_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, source, subject_id, scene, polarity, quality_passed, detection_rate, dirty): documents as catalogue rows; unlabelled ones have no polarity."""
    d, lab = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return d.select("doc_id", "source", "lang", "n_chars").join(lab, "doc_id", "left").select(
        F.concat_ws("__", "source", F.col("doc_id").cast("string")).alias("video_id"), "source", F.concat(F.lit("subj"), (F.col("doc_id") % 23).cast("string")).alias("subject_id"), F.col("lang").alias("scene"),
        F.when(F.col("toxic") == 1, "negative").when(F.col("toxic") == 0, "positive").alias("polarity"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("quality_passed"),
        ((F.col("n_chars") % 101) / 100.0).alias("detection_rate"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("dirty"), F.when(F.col("quality") == 0, "rejected").when(F.col("quality") == 1, "passed").alias("status"),
    )


def vector_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, frame, coords, quality, palm, logits, valid): embeddings as landmarks and scores, 50 to a sequence."""
    v = table(spark, sf_dir, "embeddings")
    e = F.col("embedding").cast("array<double>")
    return v.select(F.expr("CAST(vec_id DIV 50 AS BIGINT)").alias("video_id"), (F.col("vec_id") % 50).cast("int").alias("frame"), F.slice(e, 1, 63).alias("coords"), F.get(e, F.lit(63)).alias("quality"), (F.abs(F.get(e, F.lit(0))) + 0.01).alias("palm"), F.slice(e, 1, 15).alias("logits"), F.when(F.col("vec_id") % 9 == 0, 0).otherwise(1).alias("valid"), F.when(F.col("vec_id") % 7 < 3, 14).otherwise((F.col("vec_id") % 21 / 7).cast("int")).alias("label"))


# The same views as DuckDB SQL, as common table expressions.
E = """eb AS (SELECT user_id AS video_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INT) AS frame,
  CASE event_type WHEN 'click' THEN 0 WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 ELSE 14 END AS label, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, value FROM events),
e AS (SELECT video_id, frame, label, CAST(CASE WHEN k % 7 = 0 THEN 14 WHEN k % 11 = 0 THEN (label + 1) % 3 ELSE label END AS INT) AS pred, CASE WHEN value >= 5 THEN 1 ELSE 0 END AS valid, value FROM eb)"""
C = """c AS (SELECT conv_id AS video_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS frame, CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 ELSE 14 END AS label FROM conversations)"""
D = """d AS (SELECT concat(source, '__', CAST(x.doc_id AS VARCHAR)) AS video_id, source, concat('subj', CAST(x.doc_id % 23 AS VARCHAR)) AS subject_id, lang AS scene,
  CASE toxic WHEN 1 THEN 'negative' WHEN 0 THEN 'positive' END AS polarity, coalesce(quality = 1, false) AS quality_passed, (n_chars % 101) / 100.0::DOUBLE AS detection_rate, coalesce(toxic = 1, false) AS dirty,
  CASE quality WHEN 0 THEN 'rejected' WHEN 1 THEN 'passed' END AS status FROM documents x LEFT JOIN labels l ON x.doc_id = l.doc_id)"""
V = """v AS (SELECT CAST(vec_id // 50 AS BIGINT) AS video_id, CAST(vec_id % 50 AS INT) AS frame, list_transform(embedding[1:63], lambda x: CAST(x AS DOUBLE)) AS coords, CAST(embedding[64] AS DOUBLE) AS quality, abs(CAST(embedding[1] AS DOUBLE)) + 0.01 AS palm,
  list_transform(embedding[1:15], lambda x: CAST(x AS DOUBLE)) AS logits, CASE WHEN vec_id % 9 = 0 THEN 0 ELSE 1 END AS valid, CAST(CASE WHEN vec_id % 7 < 3 THEN 14 ELSE (vec_id % 21) // 7 END AS INT) AS label FROM embeddings)"""


def runs(source: str, label: str, name: str) -> str:
    """The runs of a view as a common table expression."""
    return f"""{name}_b AS (SELECT video_id, frame, {label} AS lab, CASE WHEN frame > 0 AND lag({label}) OVER (PARTITION BY video_id ORDER BY frame) IS NOT DISTINCT FROM {label} THEN 0 ELSE 1 END AS chg FROM {source}),
{name}_n AS (SELECT *, CAST(sum(chg) OVER (PARTITION BY video_id ORDER BY frame) - 1 AS INT) AS seg_id FROM {name}_b),
{name} AS (SELECT video_id, seg_id, CAST(min(lab) AS INT) AS label, CAST(min(frame) AS INT) AS seg_start, CAST(max(frame) + 1 AS INT) AS seg_end FROM {name}_n GROUP BY video_id, seg_id)"""
