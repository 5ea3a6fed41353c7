"""A corpus pipeline: five stages over the documents, each written and read again before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from carledger.llm import boilerplate, bpe, decontaminate, language, neardup
from carledger.llm.queries import WORD_BPE
from carledger.llm.tables import drop_steps, prepare, steps, stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is unknown."""
    prepare(spark)
    return language.keep_known(docs)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that many sites share. n_chars is counted anew; every document stays."""
    prepare(spark)
    return boilerplate.cleaned(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, by shingles of five words."""
    prepare(spark)
    return neardup.deduplicate(docs, width=5)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold passages of the benchmark."""
    return decontaminate.clean(docs, prepare(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text of what is left."""
    prepare(spark)
    return bpe.digests(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("language", known_language),
    ("lines", without_boilerplate),
    ("near_copies", without_near_copies),
    ("decontaminate", without_benchmark),
    ("encode", encoded),
]

#: A fitted classifier and a tokenizer have no equivalent in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`. Of the folders written on the way only the newest stays."""
    since = steps()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
        drop_steps(spark, since)
    return docs
