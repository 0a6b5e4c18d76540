"""Corpus pipeline: documents to token shards in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes each stage's rows as Parquet and reads them again for the
next, so a lost executor sends a stage back to its own input alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from titlepulse.llm.common import cut, read
from titlepulse.llm.decontaminate import without_contaminated
from titlepulse.llm.mixing import resampled
from titlepulse.llm.ngram_join import one_of_each
from titlepulse.llm.queries import TARGETS, labelled_domains
from titlepulse.llm.site_quality import keep_good
from titlepulse.llm.token_shards import token_shards


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are probably bad or toxic go."""
    return keep_good(docs, read(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that link at 80 percent of their 5-word shingles the one with
    the smallest id stays."""
    return one_of_each(docs, n=5, need=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated rows go, each judged by its own text, whatever its id."""
    return without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its fitted rate says."""
    return resampled(docs, labelled_domains(docs, read(spark, sf_dir, "labels")), TARGETS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards, read back: doc_id, start, n_tokens, ids_crc32. Workers hold
    other stages' memory too, so they keep fewer pieces."""
    return token_shards(docs, cached=1 << 15)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", token_output),
]

#: Classifiers and tokenizers cannot be expressed in SQL; tests/llm checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"stage-{k}")
    return docs
