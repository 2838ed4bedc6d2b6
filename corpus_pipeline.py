"""From raw documents to packed training sequences.

Each stage calls one operator of ``txnguard.llm`` on all that its predecessor
kept; ``run`` writes every stage's rows as Parquet in the cluster's shared folder
and reads them again for the next. Stages 1 to 4 return the columns of their
input; the last returns the pieces of packed sequences.

Cases: an empty table passes through every stage; each stage's operator defines
what null ids, null texts, repeated rows and other columns mean.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.llm import decontaminate, language_id, packing, secret_scan, simhash_gray
from txnguard.llm.common import materialize, table
from txnguard.session import configure


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model can tell, learned from the given languages of all of them."""
    return language_id.accepted(docs, language_id.fit(docs, F.lit(True)), min_score=0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHashes (3-word shingles) within 2 bits."""
    return simhash_gray.one_of_each(docs, shingle=3, max_bits=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no 10-word window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), window=10)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced in their texts."""
    return secret_scan.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: Tokens, fingerprints and models are beyond SQL; tests/llm holds the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
