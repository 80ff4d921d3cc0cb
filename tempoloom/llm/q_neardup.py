from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .neardup import near_duplicates


def op2_bag_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op2_bag_minhash_dedup": op2_bag_minhash_dedup}
