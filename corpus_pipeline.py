"""Corpus pipeline: grade documents, drop near copies, mix the sources, pack sequences.

``STAGES`` are ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and returns
a DataFrame that is written as Parquet and read again as the next one's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoalloc.llm.common import shared_folder
from geoalloc.llm.op2_quality import fit, graded
from geoalloc.llm.op4_mixing import mixed
from geoalloc.llm.op6_packing import pack
from geoalloc.llm.op7_jaccard_join import one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of the data folder."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return graded(docs, model).where("kept").select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return one_of_each(docs, 5, 80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix, which the files keep."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 ids with their ids, in the order of the rows in the files of ``docs``."""
    placed = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row_index"))
    return pack(placed, ["doc_id"], order=("file_name", "row_index"))


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_copies), ("mixing sources to target weights", mixing), ("packing", packing)]
ORACLE_SQL = None  # a fitted classifier and tokenized texts are not SQL; tests hold the stages against plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = shared_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
