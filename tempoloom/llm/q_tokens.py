from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .tokencounts import token_counts


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=512)


QUERIES = {"op7_token_counts": op7_token_counts}
