"""The corpus pipeline: stages over the documents table, each over all that the
stage before it kept. ``run`` writes every stage's output to the folder the
cluster shares and reads it back as the next stage's documents.

quality rules           documents that the weakly supervised rules reject go
n-gram jaccard join     one document of each group of linked documents stays
suffix-array dedup      passages that also start earlier are cut out
decontamination         passages of the benchmark are cut out
byte-level bpe          every text is encoded (packed ids), decoded and digested
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablejobs.llm.bpe import encode_decode, vocabulary
from tablejobs.llm.decontamination import decontaminate
from tablejobs.llm.jaccard import keep_first
from tablejobs.llm.quality_rules import keep_good
from tablejobs.llm.repeats import remove_repeats
from tablejobs.llm.store import read, saved, temporary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group linked by a Jaccard similarity of 0.8 or more."""
    return keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out all bytes of 100-byte strings that also start earlier."""
    return remove_repeats(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out the words of benchmark windows."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every text, and decode it again; the ids are what a training job reads."""
    return encode_decode(docs, *vocabulary(), ids=True)


STAGES = [("quality rules", quality), ("n-gram jaccard join", near_duplicates),
          ("suffix-array dedup", repeated_passages), ("decontamination", benchmark_passages),
          ("byte-level bpe", tokens)]

#: The stages go beyond SQL; tests/llm checks them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the stages before it and their operators saved goes."""
    docs = read(spark, sf_dir, "documents")
    with temporary(spark):
        for name, stage in STAGES:
            docs = saved(stage(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_"), keep=name == STAGES[-1][0])
    return docs
