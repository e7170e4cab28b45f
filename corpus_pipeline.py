"""A training-data pipeline over ``documents``: language, near copies, benchmark leaks, secrets, token ids.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor
kept and returns a DataFrame, which is written as Parquet and read again as
the next one's ``docs``.  All stages but the last return the columns of
``documents`` as they came, extra ones too.

Null ids: languages are judged by text, so that such rows pass; as they have
no name to be told by, near copies and leaks never remove them.  Null and
empty texts have no language and go in the first stage.  Repeated rows are
exact copies, of which the second stage leaves one.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from manifest_spark.llm import bpe, decontam, langid, secrets, simhash
from manifest_spark.llm.common import shared_dir, table, written
from manifest_spark.llm.queries import vocabulary

#: The least chance of its best language that a document needs (four languages would give 0.25 to each by guessing).
MIN_LANGUAGE_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: texts without a letter and those that fit no learned language go."""
    return langid.with_language(docs, langid.fit(docs), MIN_LANGUAGE_SCORE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return simhash.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    found = written(decontam.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct(), "contaminated")
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in the place of each secret."""
    return secrets.redact_secrets(docs, secrets.train(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of all documents."""
    return bpe.encode_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("BPE encoding", tokens),
]

#: The stages hold learned models and XXH64 fingerprints, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = os.path.join(shared_dir(spark), f"pipeline-{uuid.uuid4().hex}-{k}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
