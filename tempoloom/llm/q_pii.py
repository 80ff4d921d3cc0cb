from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .pii import pseudonymised, session_key


def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pseudonymised(docs, session_key(spark), count="n_values").select("doc_id", "text", "n_chars", "n_values")


QUERIES = {"op9_pii_pseudonyms": op9_pii_pseudonyms}
