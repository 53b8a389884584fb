"""Corpus pipeline: five stages from raw documents to token ids.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one
before it kept; all but the last return the columns of ``documents``. ``run``
writes each stage's rows as Parquet in the shared scratch folder and reads them
back, so a lost executor costs part of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm import bpe, decontaminate, quality, secrets, simhash
from subledger.llm.common import cut, read_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Null and empty texts have no n-grams and are judged by the labels' share alone;
    rows that repeat stay or go together; an empty table stays empty; without labels
    every document scores one half and goes."""
    return quality.good_documents(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that of the smallest id
    (null ids last). Null, empty and blank texts are one group; of rows that repeat
    one stays; an empty table stays empty."""
    return simhash.representatives(docs, shingle=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. Null and empty texts hold
    none; rows that repeat stay or go together; an empty table or benchmark takes
    none away."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"), window=10)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays, null and empty texts as
    they are, rows that repeat alike, columns of any name untouched."""
    return secrets.without_secrets(docs, secrets.train(docs))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digests that prove the round trip. A null or
    empty text has no ids; rows that repeat stay."""
    encoded = bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id",
        "ids",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("byte-level BPE", encode_tokens),
]

#: Learnt models and 64-bit hashes of shingles are beyond SQL: see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
