"""The corpus pipeline: five stages, each one of the operators of tracelake.llm over all that the stage before kept.

quality       documents that the quality rules reject go (operator 5)
fuzzy_lines   lines that repeat an earlier line, exactly or nearly, go; documents stay (operator 10)
simhash       one document of each near-duplicate group stays (operator 7)
decontam      documents that hold a benchmark item go (operator 6)
byte_bpe      the rest is encoded: doc_id, n_tokens, digests and ids (operator 4)

The stages' docstrings in their modules say what happens to nulls, empty
texts, repeated rows and empty tables; extra columns pass through the first four.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tracelake.llm.byte_bpe import encode  # noqa: E402
from tracelake.llm.decontam import without_matches  # noqa: E402
from tracelake.llm.fuzzy_lines import deduplicated  # noqa: E402
from tracelake.llm.quality import accepted  # noqa: E402
from tracelake.llm.shared import work_folder, written  # noqa: E402
from tracelake.llm.simhash import one_of_each  # noqa: E402
from tracelake.shipping import ship  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return accepted(docs, work_folder(spark, "quality"))


def fuzzy_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return deduplicated(docs, work_folder(spark, "fuzzy_lines"))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return one_of_each(docs, work_folder(spark, "simhash"))


def decontam(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return without_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return encode(docs)


STAGES = [("quality", quality), ("fuzzy_lines", fuzzy_lines), ("simhash", simhash), ("decontam", decontam), ("byte_bpe", byte_bpe)]

#: XXH64, tokenizers and unbounded components can't be said in DuckDB SQL; tests/llm holds the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as a table that the next one reads."""
    folder = work_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), folder, name)
    return STAGES[-1][1](spark, docs, sf_dir)
