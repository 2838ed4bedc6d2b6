"""Registered queries of the text operators, one per operator, each over its whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.llm import (
    attention_lm,
    chat_format,
    decontaminate,
    language_id,
    packing,
    periodic_runs,
    quality_pu,
    quality_rules,
    secret_scan,
    simhash_gray,
    substring_dedup,
    suffix_dedup,
    token_alignment,
)
from txnguard.llm.common import fold, table
from txnguard.session import configure

WORD_BPE, BYTE_BPE, PIECE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, learned from positives and unlabelled text of the training fold."""
    configure(spark)
    docs, held = table(spark, sf_dir, "documents"), fold("doc_id", 3, 1)
    model = quality_pu.fit(docs, table(spark, sf_dir, "labels"), ~held)
    scored = quality_pu.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SimHash of every document and its component of fingerprints within 2 bits."""
    configure(spark)
    found = simhash_gray.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 4096 tokens."""
    configure(spark)
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), capacity=4096, end_id=1)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate secret of all documents with its place, score and verdict; the secret itself as a digest."""
    configure(spark)
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", F.length("candidate").alias("length"), F.sha2("candidate", 256).alias("candidate_sha256"), "score", "secret")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a 10-word window of a benchmark item."""
    configure(spark)
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and whether the rules keep it."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    return quality_rules.apply(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


#: Added to the conversations: texts that hold the template's own control strings.
CONTROL_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, read back from the output."""
    configure(spark)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(CONTROL_TURNS, turns.schema))
    return chat_format.read_back(chat_format.format_turns(turns))


def op8_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attention model's and the unigram model's log10 probability of every document, learned from six sevenths of them."""
    configure(spark)
    docs, held = table(spark, sf_dir, "documents"), fold("doc_id", 7, 2)
    found = attention_lm.score(docs, ~held, public_tokenizers.path(WORD_BPE), end_id=49407)
    return found.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 50-word windows that a document with a smaller id has."""
    configure(spark)
    return substring_dedup.dedup(table(spark, sf_dir, "documents"), window=50).drop("kept")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, ~fold("doc_id", 4, 2))
    found = language_id.detect(docs, model, keep=["doc_id"])
    return found.select("doc_id", fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts of a tenth of them, chosen and cut by the ids' crc32, made periodic from some word on."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    cut = docs.select("doc_id", "text", crc.alias("h"), F.floor(crc / 10).alias("g"), F.when(crc % 10 == 0, words).alias("w")).withColumn("n", F.size("w"))
    cut = cut.withColumn("a", F.expr("if(n > 0, cast(g % n as int), 0)")).withColumn("p", F.expr("1 + floor((n - a) / (3 + g % 8))"))
    turned = F.expr("concat_ws(' ', slice(w, 1, a), transform(sequence(a, n - 1), i -> w[cast(a + (i - a) % p as int)]))")
    return cut.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), turned).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document's words, and the words left when each run keeps its first period."""
    configure(spark)
    found = periodic_runs.detect(with_planted_periods(table(spark, sf_dir, "documents")), min_length=6, min_exponent=4)
    # lengths by periods are compared exactly, by products
    first = F.expr("""aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>),
      (best, r) -> if(best is null or r.length * best.period > best.length * r.period, r, best))""")
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    milli = F.expr("1000 * best.length div best.period").alias("exponent_milli")
    digests = F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")
    return found.withColumn("best", first).select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", milli, *digests)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens that two tokenizers make of every document."""
    configure(spark)
    return token_alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 50-byte strings that a document with a smaller id has."""
    configure(spark)
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"), window=50).drop("kept")


def queries() -> dict:
    found = [v for k, v in globals().items() if k.startswith("op") and callable(v)]
    return {f.__name__: f for f in found}
