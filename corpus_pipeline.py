"""From raw documents to a sharded mix: rules, near copies, benchmark passages, mixing, shards.

A stage takes ``(spark, docs, sf_dir)``; its result is written and read again as the
documents of the next. Rows keep the columns and values they came with, whatever the
columns are called; without rows every result is empty. Texts of any length are treated
whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelbook.llm import decontaminate, mixing, quality, sharding, similarity
from reelbook.llm.common import discarding, saved, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts go, repeated rows are judged alike."""
    return quality.keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies; each empty text is a group of its own.

    Of rows that repeat id and text one stays: that with the least hash of its columns.
    """
    return similarity.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; those that are mostly passages go, empty ones stay."""
    return decontaminate.remove_hits(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a null source is a source, equal sources weigh by order."""
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their place in it; ``size``, ``text_crc32``, ``shard`` and
    ``slot`` replace columns of these names. Equal texts share a shard."""
    return sharding.shard(docs, keep=docs.columns)


STAGES = [
    ("quality rules", good_documents),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
    ("sharding", sharded),
]

#: Min-hashes and draws have no counterpart in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the working tables of a stage go when its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with discarding(spark):
            docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"), stay=True)
    return STAGES[-1][1](spark, docs, sf_dir)
