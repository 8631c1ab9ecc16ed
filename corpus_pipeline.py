"""Corpus pipeline: quality rules, exact dedup, near-duplicate groups, personal data, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last return the columns of documents:

* quality_rules: documents that the base rule or the log-likelihood ratio rejects go; the ratio is fitted on the stage's
  own input, its trusted documents are those labelled quality 1.
* exact_dedup: of equal texts, white space aside, the longest stays, then the smallest doc_id.
* ngram_jaccard: of each group that links of Jaccard 0.8 or more over 5-word shingles connect, the smallest doc_id stays
  (null ids come last, and equal texts of null ids are one document).
* pii: personal data is replaced by its kind in brackets; n_chars follows the text.
* packing: pieces of windows of 4096 tokens, as op1 returns them, with the ids themselves.

An empty table passes through every stage and packs into no pieces; extra columns are carried to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.llm import exact_dedup, jaccard, packing, pii, rules
from wardline.llm.common import staged, table

#: SQL cannot express the fitted ratio and the boosted candidates; tests hold each stage against brute force instead.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.keep_good(docs, rules.fit_weights(docs, rules.trusted_ids(spark, sf_dir)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_repeats(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, jaccard.Rule(words=5, percent=80))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("pii", redact),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs
