"""From raw documents to token files: language, near copies, benchmark leaks, mixing, binary output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from issuerlake.llm.decontaminate import clean
from issuerlake.llm.jaccard import keep_one
from issuerlake.llm.language import accepted
from issuerlake.llm.mixing import mixed, quality_domains
from issuerlake.llm.queries import WEIGHTS, table
from issuerlake.llm.shared import materialize, scratch
from issuerlake.llm.tokenfiles import roundtrip
from issuerlake.llm.tokens import tokenizer_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; models come from the rows with a language."""
    return accepted(docs, docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near copies (five words, similarity 0.8)."""
    return keep_one(docs, words=5, percent=80)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item."""
    return clean(docs, table(spark, sf_dir, "benchmark"), window=10)


def weighted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents taken as often as the target shares of good, poor and toxic text ask."""
    return mixed(docs, quality_domains(table(spark, sf_dir, "labels")), WEIGHTS)


def token_file(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's ids stand in the token file, read back from it."""
    return roundtrip(docs, scratch(spark, "tokens"), tokenizer_path())


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmarks),
    ("mixing", weighted),
    ("token_file", token_file),
]

#: Stages like classification and coding have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
