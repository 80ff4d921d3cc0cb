"""The corpus pipeline: five stages over documents, each of one operator of tempoloom.llm.

Each stage function takes (spark, docs, sf_dir) and gives a DataFrame that is
written as Parquet and read again as the next stage's docs. Columns of docs other
than doc_id, text, lang, source, n_chars are kept, whatever their names. Null
texts are empty: the classifier scores them as such, and they form one class
of near duplicates; rows without a doc_id pass all stages but the classifier
unchanged but for their personal values; rows that share a doc_id are one
document to the near dedup; equal rows are treated alike; texts are taken
whole, however long; empty tables give empty tables, and without labels of
both qualities the classifier rejects by their share alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tempoloom.llm.cdc import repeated_spans, without_spans
from tempoloom.llm.common import discard, kept, temporary, written
from tempoloom.llm.cotrain import accepted, fit
from tempoloom.llm.neardup import without_near_duplicates
from tempoloom.llm.pii import pseudonymised, session_key
from tempoloom.llm.q_packing import packed


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return accepted(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return without_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay where they occur first."""
    return without_spans(docs, repeated_spans(docs))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values give way to pseudonyms of the same format."""
    return pseudonymised(docs, session_key(spark))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: a row for each piece of a document."""
    return packed(docs)


STAGES = [("quality classifier", quality), ("near dedup", near_dedup), ("substring dedup", substring_dedup), ("pii", pii), ("packing", packing)]
#: No stage of this kind can be put as SQL; the whole is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents in sf_dir."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (_, stage) in enumerate(STAGES[:-1]):
        with temporary(spark):  # what a stage has written itself goes once its rows are stored
            out = stage(spark, docs, sf_dir)
            with kept():
                docs = written(out, f"stage{number}")
        if last is not None:
            discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
