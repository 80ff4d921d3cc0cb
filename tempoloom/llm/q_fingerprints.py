from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .orderminhash import edit_sensitivity


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_sensitivity(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op1_order_minhash": op1_order_minhash}
