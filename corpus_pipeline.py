"""From raw documents to token ids: toxicity, near-duplicates, repeated passages, benchmark passages, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; ``run`` writes each result to the shared folder
and reads it back.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from assayer.llm import bpe, contamination, overlap, substrings, toxicity
from assayer.llm.queries import RANKS
from assayer.llm.scan import table
from assayer.session import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.mild_only(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return overlap.keep_first(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.cut_passages(docs, substrings.repeated_passages(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.clean_of(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("repeated_passages", cut_repeated_passages),
          ("decontamination", drop_contaminated), ("byte_bpe", encode)]
#: Trained scores, chains and merges have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
