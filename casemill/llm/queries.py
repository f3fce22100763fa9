"""The registered queries of the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.llm import chat, decontam, licenses, packing, quality, secrets, simhash, substring, tokens, warc


def tokenizer_path(name: str) -> str:
    """A tokenizer's file: in $TOKENIZER_DIR, else where the package of public tokenizers has it."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join(F.transform("licenses", lambda x: x["license"]), ",").alias("licenses"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(table(spark, sf_dir, "documents"))
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))
    return out.select("doc_id", "n_words", lost.alias("n_removed"), F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokens.write_tokens(table(spark, sf_dir, "documents"), tokenizer=tokenizer_path("word_bpe_49k.json"), end_id=1)
    return tokens.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer=tokenizer_path("byte_bpe_50k.json"), size=2048, end_id=0).drop("ids")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op6_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.preference_pairs(table(spark, sf_dir, "conversations"), F.floor(F.col("conv_id") / 2).cast("long"), F.pmod(F.col("conv_id"), F.lit(2)).cast("int"))
    return out.withColumns({c: chat.spans_text(F.col(c)) for c in ("chosen_mask", "rejected_mask")})


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_groups(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_join("hit_items", ",")
    return out.select("doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"), F.sha2(F.encode(items, "UTF-8"), 256).alias("items_sha256"), "contaminated")


def _span_list(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.find_secrets(table(spark, sf_dir, "documents"), vocabulary=tokenizer_path("byte_bpe_50k.tiktoken"))
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return out.select("doc_id", *map(count, ("assign", "access", "hex")), F.sha2(F.encode(_span_list(base), "UTF-8"), 256).alias("base_sha256"), _span_list(F.col("secrets")).alias("spans"), count("random"))


def op10_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_warc(table(spark, sf_dir, "pages"))
    return warc.read_warc(spark, path, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    own = (op1_license_scan, op2_substring_dedup, op3_token_output, op4_best_fit_packing, op5_quality_rules, op6_preference_format, op7_simhash_dedup, op8_decontamination, op9_secret_scan, op10_warc_archive)
    return {f.__name__: f for f in own} | {"pipeline": pipeline}
