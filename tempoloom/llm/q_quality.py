from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .cotrain import fit, scored


def op6_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scored(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


QUERIES = {"op6_co_training": op6_co_training}
