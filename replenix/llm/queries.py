"""Registered queries of the training-data operators: each reads its whole tables and returns its whole result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replenix.llm import (
    align, bpe, decontaminate, forest, langid, mixing, nra, pseudolm, quality, ranked, secrets, tokenfiles, toxicity)
from replenix.llm.common import held_out, shared_folder, ship, table

MOST_TOKENS = 4096
TOXIC_FROM = 0.3
END_ID = 1


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(table(spark, sf_dir, "documents", ["doc_id", "text", "source"]))
    return mix.select("doc_id", "size", F.col("source_size")[0].alias("source_size"), F.col("target")[0].alias("target"),
                      (F.size("uses") * F.col("size")).cast("long").alias("taken"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    counted = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                          bpe.token_count(F.col("text"), tokenizer_path("piece_bpe_32k.model")).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > MOST_TOKENS)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    model = toxicity.fit(docs, labels.where(~held_out("doc_id", 4, 2)))
    scored = docs.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"),
                         toxicity.toxicity(F.col("text"), model, spark).alias("found"))
    return scored.select("doc_id", "held_out", "found.score",
                         (F.col("found.score") >= TOXIC_FROM).cast("int").alias("predicted"), "found.evidence")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    training = pseudolm.Training()
    words = pseudolm.vocabulary(docs, training=training)
    coded = pseudolm.encoded(docs, words)   # read by the training and by the scoring
    found = pseudolm.scored(coded, words, pseudolm.trained_net(coded, words, training), training)
    return found.select(F.col("k").cast("long").alias("doc_id"), "n_tokens", "log_likelihood",
                        F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")).alias("mean_log_prob"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    found = docs.select("doc_id", secrets.secret_spans(F.col("text")).alias("found"))
    kinds = [r.kind for r in secrets.BASE_RULES]

    def joined(spans) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in kinds],
        F.sha2(joined(F.filter("found", lambda s: s.kind.isin(kinds))), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    tokenfiles.write(table(spark, sf_dir, "documents", ["doc_id", "text"]), folder,
                     tokenizer_path("word_bpe_49k.json"), END_ID)
    return tokenfiles.digests(tokenfiles.read(spark, folder), tokens=False)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forest.near_duplicates(table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents", ["doc_id", "text", "lang"]))
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents", ["doc_id", "text"]),
                                        table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    network = langid.fit(docs.where(~held_out("doc_id", 5, 0)))
    labelled = docs.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"),
                           langid.language(F.col("text"), network, spark).alias("found"))
    return labelled.select("doc_id", "held_out", "found.lang_pred", "found.score")


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra.top_k(table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), "vec_id % 50 = 0")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(table(spark, sf_dir, "documents", ["doc_id", "text"]), table(spark, sf_dir, "benchmark"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignments(table(spark, sf_dir, "documents", ["doc_id", "text"]),
                            tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_source_mix, op2_token_counts, op3_toxicity, op4_lm_scoring, op5_secret_scan, op6_token_files,
        op7_near_duplicates, op8_quality_rules, op9_decontamination, op10_language_id, op11_topk_search,
        op12_ranked_search, op13_tokenizer_alignment)}
