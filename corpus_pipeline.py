"""Corpus pipeline: the stages applied to ``documents``, each written as Parquet
and read again as the next one's input.

1. ``toxicity``: documents that the classifier chain rejects go.
2. ``line_dedup``: repeated lines go from the texts; no document goes.
3. ``simhash_near_dedup``: one document of each SimHash component stays.
4. ``decontamination``: documents that hold a benchmark item go.
5. ``packing``: the rest is packed into token windows; a row per piece.

All stages but the last return the columns of ``documents``.  Nulls, empty texts,
repeated rows and empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dwkit.llm import decontam, line_dedup, packing, simhash, toxicity
from dwkit.llm.common import staged
from dwkit.llm.queries import CATEGORIES, table, tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"), CATEGORIES, reject="toxic")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_group(docs, k=3, bound=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Its processes share their executor with what earlier stages left there, so they remember fewer words.
    return packing.pack(docs, tokenizer(), table_words=250_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL cannot state the stages (trained models, hashes, token ids); tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
