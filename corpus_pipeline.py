"""The corpus pipeline: quality, near duplicates, personal data, mixing and packing, each stage over all rows of the last."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from deltaloom.llm import op1_quality, op2_jaccard, op3_mixing, op5_packing, op7_pii
from deltaloom.llm.common import scratch_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Null and empty texts have a score like others; equal texts fare alike. Where labels has no row of each label every
    document stays. Labels of ids that docs lacks, and null ones, count for nothing.
    """
    return op1_quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that of the smallest doc_id.

    Rows without words or with a null doc_id are near no other and all stay. Rows that share a doc_id are one document
    only where they share their text too.
    """
    return op2_jaccard.keep_one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets; null and empty texts stay as they are."""
    return op7_pii.redacted(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by weight: a row for each pass over a document, with the words that the mix takes in it.

    Documents without words are in no mix; a null source is a source of its own; repeated rows are taken as documents
    of their own.
    """
    return op3_mixing.mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens; a null or empty text is the one closing token."""
    return op5_packing.packed_pieces(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixing", mixing), ("packing", packing)]
#: Learned weights, components and tokens can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from documents on, each written to the shared folder and read again by the next.

    What a stage has written goes once the next stage's rows are there, so that two of them take space at most.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            folder = spark._jvm.org.apache.hadoop.fs.Path(before)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        before = path
    return docs
