from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .secrets import secret_spans


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return secret_spans(docs).select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


# DuckDB's regular expressions have neither spans nor leftmost non-overlapping
# positions in code points, so the query is tested against a brute-force scan.
QUERIES = {"op8_secret_scan": op8_secret_scan}
