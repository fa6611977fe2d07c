"""A corpus pipeline of five stages over the table of documents.

Each stage takes what its predecessor kept and its decisions take effect: documents that the quality
classifier rejects go; of each group of near-duplicates one document stays; passages of documents
that stand in an earlier one go; documents that hold a benchmark item go; what is left is encoded.

Null and empty texts are no near-duplicates of anything and stay empty; a null doc_id takes nothing away
and keeps its text; of rows that repeat an id and a text one stays; extra columns pass through all stages but
the last, whatever their names; empty tables give empty results.  The last stage returns counts, digests
and the token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from echoloom.llm import bpe, contamination, cotraining, near_dup, suffix_dedup
from echoloom.llm.common import release, stored, table, written

#: Fifty words and the spaces between them have at least this many bytes.
PASSAGE_BYTES = 99


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cotraining.keep_good(docs, cotraining.fit(cotraining.features(docs), table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one_of_each(docs, size=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_substrings(docs, min_len=PASSAGE_BYTES)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.without_items(docs, table(spark, sf_dir, "benchmark"), size=5, percent=80)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(docs, path, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality_classifier", quality),
    ("minhash_near_dup", near_duplicates),
    ("suffix_family", repeated_passages),
    ("decontamination", decontaminated),
    ("prefix_bpe", encoded),
]

#: The classifier and the encoder have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        mark = written()
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
            release(spark, mark, but=1)  # what the stage wrote on its way
    return docs
