from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cdc import repeated_spans


def op3_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = repeated_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return spans.select(F.col("id").alias("doc_id"), F.col("first_id").alias("first_doc_id"), "start", "end", "words")


QUERIES = {"op3_chunk_dedup": op3_chunk_dedup}
