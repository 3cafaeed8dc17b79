"""Corpus pipeline: quality, near-duplicates, repeated passages, benchmark leaks, mixture.

Each stage takes (spark, docs, sf_dir), works on every document that the stage before it kept, and returns a DataFrame
that is written as Parquet and read again as the next one's docs. All but the last return the columns of documents.

In every stage a null text counts as empty, a null id is a value like others, an empty table gives no rows, and further
columns are kept, whatever their names. Texts of any length are judged as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idhealth.llm import decontaminate, mixing, neardup, quality, suffixdedup
from idhealth.llm.base import read, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the ordinal classifier, fitted on the labelled ones, grades as good.

    Rows are judged one by one: equal texts alike, repeated rows each. Without labels everything stays.
    """
    return quality.select_good(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates: the one of the least id, of its rows that of the least text digest.

    Rows with a null id are classes of their own; of rows equal in id and text any one stays.
    """
    return neardup.without_near_duplicates(docs)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every string of 200 bytes that stands anywhere else too; n_chars follows the text. All rows stay, texts may get empty.

    No occurrence is preferred: equal texts of 200 bytes or more lose everything, repeated rows too.
    """
    return suffixdedup.remove_repeats(docs, keep_text=True, counted=False).withColumn("n_chars", F.char_length("text").cast("long"))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold ten consecutive words of a benchmark item, or all words of a shorter one.

    Rows equal in id and text are judged alike. Without items everything stays.
    """
    return decontaminate.without_benchmark(docs, read(spark, sf_dir, "benchmark"))


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents of each source up to its target; adds mix_size and mix_taken (replacing columns of these names).

    Which are taken goes by the hashes of their ids: rows that share an id are taken alike. Null is a source of its own.
    """
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("passages", passage_stage),
    ("benchmark", benchmark_stage),
    ("mixture", mixture_stage),
]

#: A fitted model decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
