"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echoloom.llm import bpe, contamination, cotraining, license_scan, near_dup, oracles, page_text, permutation_index, suffix_dedup, url_reputation, warc
from echoloom.llm.common import table

#: The rules of op10.
URL_RULES = tuple(
    url_reputation.parse_rule(*r)
    for r in (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
)


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op2_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(table(spark, sf_dir, "documents"))


def op6_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80).drop("class")


def op7_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives_of_pages(table(spark, sf_dir, "pages"))


def op8_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.substring_digests(table(spark, sf_dir, "documents"), min_len=50)


def op9_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = cotraining.features(table(spark, sf_dir, "documents"))
    return cotraining.score(known, cotraining.fit(known, table(spark, sf_dir, "labels")))


def op10_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A page shows the document whose id stands in its path, as /en/7817; its label is the outcome.
    item = F.regexp_extract(F.col("path"), r"^/[a-z]{2}/([0-9]{1,18})", 1)
    item = F.when(item != "", item.cast("long"))
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").cast("long").alias("item"), F.when(F.col("quality") == 0, 1).otherwise(0).alias("bad"))
    found = url_reputation.judge(table(spark, sf_dir, "pages"), outcomes, URL_RULES, item)
    return found.select("page_id", "host", "path", "rule", "verdict")


QUERIES = {
    "op1_permutation_index": op1_permutation_index,
    "op2_prefix_bpe": op2_prefix_bpe,
    "op3_decontamination": op3_decontamination,
    "op4_page_differencing": op4_page_differencing,
    "op5_license_scan": op5_license_scan,
    "op6_minhash_near_dup": op6_minhash_near_dup,
    "op7_warc_derivatives": op7_warc_derivatives,
    "op8_suffix_family": op8_suffix_family,
    "op9_co_training": op9_co_training,
    "op10_host_reputation": op10_host_reputation,
}

#: The others have no SQL form: an approximate search (its recall is tested against brute force), a
#: rank table and merges, HTML parsing, alignment, iterative fits.
ORACLES: dict[str, str] = {
    "op3_decontamination": oracles.OP3,
    "op6_minhash_near_dup": oracles.OP6,
    "op8_suffix_family": oracles.OP8,
    "op10_host_reputation": oracles.op10(URL_RULES),
}
