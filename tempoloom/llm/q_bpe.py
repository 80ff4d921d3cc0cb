from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_decode, bpe_encode


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    both = bpe_decode(bpe_encode(docs, *ranks), *ranks)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op4_bpe_round_trip": op4_bpe_round_trip}
