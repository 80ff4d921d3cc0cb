from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .packing import pack


def packed(docs: DataFrame) -> DataFrame:
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=1024)


def op10_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op10_harmonic_packing": op10_harmonic_packing}
