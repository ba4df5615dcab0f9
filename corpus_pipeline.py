"""The corpus pipeline: documents through the stages in order, each written and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``, each with the values it came with: a column that is named like a verdict (``score``, ``predicted``, ``lang_pred``, ``rejected``,
in any case) passes through, since the stages judge copies under names of their own.

Cases, for all stages: a null text counts as empty; texts of any length are read whole; repeated rows are judged alike, one by one, and a
repeated document counts as a copy in the near-duplicate stage; an empty table gives an empty result. What becomes of a row with a null or empty
text: the toxicity stage keeps it (no evidence), the language stage drops it (no letter), the near-duplicate stage keeps one of all empty ones, the
mixing stage weighs it with no tokens, the last stage gives it no ids. Ties: equal scores are judged alike; of a near-duplicate group the smallest
doc_id stays, a null id last; copies made by the mixing stage are equal rows.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from goldmart.llm import bpe, langid, mixing, simhash, toxicity  # noqa: E402
from goldmart.llm.common import crc_fold, table  # noqa: E402
from goldmart.session import materialize  # noqa: E402


def judged(docs: DataFrame, judge, verdict: str) -> DataFrame:
    """The rows of ``docs`` for which ``verdict`` holds on ``judge(rows, text column)``; columns come back untouched."""
    hidden = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    kept = judge(hidden, f"c{docs.columns.index('text')}").where(verdict)
    return kept.select(*hidden.columns).toDF(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.7, learned from the labels of the documents table."""
    model = toxicity.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_fold("doc_id", 3) != 1)
    return judged(docs, lambda rows, text: toxicity.score_texts(rows, model, text=text), "predicted = 0")


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has letters and fits a learned language."""
    model = langid.learn(table(spark, sf_dir, "documents"), crc_fold("doc_id", 4) != 2)
    return judged(docs, lambda rows, text: langid.predict(rows, model, text=text), "not rejected")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (three words, two bits): the smallest doc_id."""
    return simhash.keep_one(docs, shingle=3, radius=2)


#: Shares of the training tokens by the quality that the labelled table tells.
TARGETS = {"high": 0.9, "low": 0.1}


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by the rates that bring the expected tokens of each domain to its target."""
    labels = table(spark, sf_dir, "labels").where("toxic = 0")
    domain = F.when(labels["quality"] == 1, "high").when(labels["quality"] == 0, "low")
    found = mixing.rates(docs, labels.select(F.col("doc_id").alias("id"), domain.alias("domain")), TARGETS)
    return mixing.mix(docs, found)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text: doc_id, n_tokens, ids (little-endian unsigned 32-bit)."""
    import public_tokenizers

    coded = bpe.encode(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", "ids")


STAGES = [
    ("toxicity", drop_toxic), ("language_id", drop_unknown_language), ("simhash_near_dedup", deduplicate),
    ("source_mixing", mix_sources), ("byte_bpe", encode_texts),
]

#: The classifiers, fingerprints and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
