"""The registered queries of the operators, over the whole tables."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from roadflux.llm import alignment, chat, decontamination, language, mixing, phrases, simhash, substrings, suffixes, topk, toxicity, urls, warc

TOKENIZERS = "/opt/tokenizers"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffixes.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, toxicity.grades_of(table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).select("doc_id", "severity", "grade", "toxic_score", "toxic")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = simhash.grouped(table(spark, sf_dir, "documents"))
    return done.select(F.col("id").alias("doc_id"), "fingerprint", F.col("component").alias("component_id"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    done = urls.judge(pages, urls.decided_by_rules(pages))
    return done.select("page_id", "host", "path", "rule", "verdict")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substrings.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return done.select("doc_id", (F.size("leaked") > 0).alias("contaminated"), F.size("leaked").alias("n_items"), "leaked")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    done = language.predict(docs, language.learn(docs))
    return done.select(F.col("id").alias("doc_id"), "held_out", "lang_pred", "score")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mined(table(spark, sf_dir, "documents"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    done = chat.digests(chat.formatted(turns.unionByName(own)))
    return done.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    a, b = (Path(os.path.join(tokenizers, name)).read_bytes() for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    done = alignment.align(table(spark, sf_dir, "documents"), a, b)
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_exact_topk": op2_exact_topk,
    "op3_toxicity": op3_toxicity,
    "op4_source_mix": op4_source_mix,
    "op5_simhash": op5_simhash,
    "op6_url_filter": op6_url_filter,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_language_id": op9_language_id,
    "op10_warc": op10_warc,
    "op11_phrases": op11_phrases,
    "op12_chat_format": op12_chat_format,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
    "pipeline": corpus_pipeline.run,
}
