"""One query per operator, over the whole table, and their DuckDB SQL."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from titlepulse.llm import decontaminate, fim, license_scan, seed_extend, warc_merkle, zfast_trie
from titlepulse.llm.common import cut, read
from titlepulse.llm.exact_dedup import exact_dedup
from titlepulse.llm.license_scan import scan, templates
from titlepulse.llm.ngram_join import jaccard_components
from titlepulse.llm.mixing import soft_mixing
from titlepulse.llm.site_quality import sample_ids, site_quality
from titlepulse.llm.linear import FIT_ROWS
from titlepulse.llm.suffix_dedup import remove_repeats
from titlepulse.llm.token_shards import token_shards
from titlepulse.llm.url_rules import filter_urls

#: Shares of all tokens by domain (language).
TARGETS = {"de": 0.2, "en": 0.5, "es": 0.15, "fr": 0.15}


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards(read(spark, sf_dir, "documents"))


def op2_warc_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = cut(warc_merkle.archive(read(spark, sf_dir, "pages")), "archive", compression="zstd")
    return warc_merkle.audit(records, warc_merkle.damaged_copy(records)).select("file_id", "page_id", "off", "len", "sha256")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


def labelled_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, bad): a page takes the labels of the document of its number."""
    labels = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"),
                                                  ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return read(spark, sf_dir, "pages").join(labels, "page_id").select("url", "bad")


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"), labelled_urls(spark, sf_dir))


def labelled_domains(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, text, domain) of a bounded sample of clean labelled rows; the
    domain is the language."""
    ids = sample_ids(labels.filter("quality = 1 and toxic = 0"), rows).select(F.col("doc_id").alias("labelled"))
    return (docs.join(ids, F.col("doc_id") == F.col("labelled"), "left_semi")
            .select("doc_id", "text", F.col("lang").alias("domain")))


def op5_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return soft_mixing(docs, labelled_domains(docs, read(spark, sf_dir, "labels")), TARGETS)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"))


def op7_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"), templates(spark))


def op9_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_zfast_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zfast_trie.conversation_trie(read(spark, sf_dir, "conversations"))


def op12_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_extend.remove_repeated_words(read(spark, sf_dir, "documents"))


def op13_block_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fill_in_middle(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_token_shards, op2_warc_merkle, op3_ngram_join, op4_url_rules, op5_soft_mixing, op6_suffix_dedup, op7_block_naming,
                                   op8_license_scan, op9_site_quality, op10_decontamination, op11_zfast_trie, op12_seed_extend, op13_block_rotation)}

ORACLE = {
    "op2_warc_merkle": warc_merkle.ORACLE,
    "op7_block_naming": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') x FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY x) keep_id, count(*) OVER (PARTITION BY x) group_size,
       doc_id = min(doc_id) OVER (PARTITION BY x) kept, sha256(x) text_sha256 FROM t
""",
    "op8_license_scan": license_scan.oracle(),
    "op10_decontamination": decontaminate.ORACLE,
    "op11_zfast_trie": zfast_trie.ORACLE,
    "op12_seed_extend": seed_extend.ORACLE,
    "op13_block_rotation": fim.ORACLE,
}
