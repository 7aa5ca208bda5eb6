"""The corpus pipeline: quality rules, near-duplicates, benchmark items, mixing and sharding, each written before the next.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``, the table ``documents`` or what its predecessor kept. All but the last return the columns of
``docs``, whatever others besides doc_id, text, lang and source there are and however they are called. An empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, mixing, quality, sharding, simhash
from tessera.llm.common import shared_folder, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep.

    A null or empty text fails the base rule on words. A null language or source is a group of its own. Repeated rows are judged alike and stay
    repeated; a value that equals a fence passes.
    """
    return quality.quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id: shingles of five words, similarity 0.8 or more.

    Of rows that tie in doc_id, the one whose columns hash lowest stays; of repeated rows, one. Rows without doc_id come last. Null and empty texts
    are one group.
    """
    return simhash.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that contain no benchmark item: under 80 % of the shingles of each.

    Null and empty texts contain nothing and stay. Rows with one doc_id, null included, count as one document and go together. Repeated rows stay repeated.
    """
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix draws them, up to three times.

    Null and empty texts have no words and are drawn with their block. A null source is a source of its own. Rows that tie in source, doc_id and size are drawn
    alike; repeated rows stay repeated.
    """
    return mixing.mixed(docs)


def byte_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The manifest of the shards: a row for each document that the mix has drawn, with its shard and slot.

    A null text counts as empty. Equal texts, repeated rows among them, are in one shard, each with a slot of its own.
    """
    return sharding.shard_table(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("byte_sharding", byte_sharding),
]

#: SQL has no XXH64 and no differencing; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents``; each stage's rows are written as Parquet and read again.

    The files go to the session's shared folder; a stage's are deleted when the next has been written, the last one's when the session ends.
    """
    top = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(top).getFileSystem(spark._jsc.hadoopConfiguration())
    store.deleteOnExit(path(top))
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{k}-{name}")
        docs = spark.read.parquet(f"{top}/{k}-{name}")
        if k:
            store.delete(path(f"{top}/{k - 1}-{STAGES[k - 1][0]}"), True)
    return docs
