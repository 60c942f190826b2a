"""From raw documents to token files: each stage reads what the one before it has written."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tracewell.llm.common import stored
from tracewell.llm.decontaminate import without_benchmark
from tracewell.llm.mixing import mix
from tracewell.llm.ngram_join import one_of_each
from tracewell.llm.quality_crf import fit_quality, keep_good
from tracewell.llm.queries import VOCABULARY, table
from tracewell.llm.token_files import token_files


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the line field takes for good."""
    return keep_good(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group whose five-word shingles link at a similarity of 0.8 or more."""
    return one_of_each(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what holds no passage of the benchmark."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents, some more than once, until sources have their target weights."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token files and returns what they hold of each document."""
    return token_files(docs, public_tokenizers.path(VOCABULARY))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing), ("tokens", tokens)]
ORACLE_SQL = None  # learned scores and tokenization are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs if not k else stored(docs, f"stage-{k}"), sf_dir)
    return docs
