"""From raw documents to token ids: language, near-duplicates, decontamination, secrets, BPE.

Each stage takes the documents that the one before it kept, as a Parquet table, and all
but the last return the columns of documents. Extra columns pass through, whatever their
names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyweave.llm import bpe, decontaminate, language, minhash, secret_scan
from tallyweave.llm.common import fresh, read, written
from tallyweave.llm.queries import RANKS, bpe_digest


def keep_known_languages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents whose language is undetermined: null, empty or without a letter."""
    into = (fresh(docs, "lang_pred"), fresh(docs, "score"))
    return language.identify(docs, into=into).filter(F.col(into[0]) != "und").drop(*into)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps the document with the least doc_id of each group (5-word shingles, 0.8 or more)."""
    return minhash.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a benchmark item, or a shorter item."""
    return decontaminate.clean(docs, read(spark, folder, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Replaces secrets in the texts; n_chars, where it is a column, follows the new text."""
    spans = fresh(docs, "secrets")
    found = secret_scan.scan(docs, secret_scan.count_transitions(docs), into=spans)
    if "n_chars" not in docs.columns:
        return secret_scan.redact(found, spans=spans)
    changed = fresh(found, "changed")
    redacted = secret_scan.redact(found.withColumn(changed, F.size(spans) > 0), spans=spans)
    kind = docs.schema["n_chars"].dataType
    return redacted.withColumn("n_chars", F.when(F.col(changed), F.length("text").cast(kind)).otherwise(F.col("n_chars"))).drop(changed)


def encode_tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the bytes they decode to."""
    return bpe_digest(bpe.encode(docs.select("doc_id", "text"), RANKS, public_tokenizers.PATTERN, decoded="decoded"))


STAGES = [
    ("language", keep_known_languages),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("tokens", encode_tokens),
]

#: Language identification and the secret models are trained; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    *inner, (_, last) = STAGES
    for _, stage in inner:
        docs = written(stage(spark, docs, folder))
    return last(spark, docs, folder)
