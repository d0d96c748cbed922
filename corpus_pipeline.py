"""A corpus pipeline: documents pass through the stages in order; each stage's rows are written and reread as the next one's.

Stages, each by one operator of filigree.llm: language ID (rejected documents go), MinHash near-duplicates (one document
of each group stays), benchmark decontamination (documents with leaked passages go), secret scans (found secrets are
replaced by their kind), BPE (token ids of what is left). Extra columns of documents pass through all stages but the
last. An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree.llm import bpe, decontaminate, langid, neardup, queries, secrets
from filigree.llm.common import Workspace, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which a language is found."""
    found = langid.predict(docs, langid.learn(docs))
    return found.where("accepted").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates: five-word shingles, a similarity of 0.8 or more."""
    return neardup.deduplicate(docs, 80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without a benchmark passage."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by their kind; n_chars follows the text."""
    return secrets.redact(docs, secrets.scan(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their count and the digests of ids and decoded text."""
    return bpe.encode_documents(docs.select("doc_id", "lang", "source", "text"), queries.vocabulary_path(), ("n_tokens", "ids", "ids_sha256", "decoded_sha256")).drop("text")


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("BPE encoding and decoding", tokens),
]

#: SQL can't express the language model, the signatures or the vocabulary; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole table of documents."""
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = ws.keep(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
