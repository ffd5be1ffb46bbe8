"""The registered queries of this package: a function of (spark, folder of the tables) each."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import (
    conversation_repair, cotraining, decontaminate, filter_audit, html_extract, licenses, packing, quality_rules, secrets, simhash, suffix_dedup,
    swap_packing, token_counts)
from tradewind.llm.frames import table

ORACLE: dict[str, str] = {"op11_filter_interaction_audit": filter_audit.ORACLE}
TOKENIZER = "byte_bpe_50k.json"
ROWS_A_FILE = 100_000


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return found.select("doc_id", *[count(k) for k in secrets.BASE_KINDS],
                        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = suffix_dedup.remove_repeats(docs)
    kept = F.sha2("kept", 256).alias("kept_sha256")
    digests = found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                           F.size("spans").cast("long").alias("n_spans"), kept)
    # the rows are a hundredth of the texts: they leave the tasks that hold texts and Python workers, for a few files to be written
    return digests.repartition(docs.count() // ROWS_A_FILE + 1)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cotraining.score(docs, cotraining.fit(docs, table(spark, sf_dir, "labels")))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_conversation_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.summary(conversation_repair.repair(damaged))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = swap_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_suffix_dedup, op3_decontamination, op4_token_counts, op5_license_scans, op6_secret_scans, op7_quality_rules,
    op8_quality_classifier, op9_html_extraction, op10_simhash_near_dedup, op11_filter_interaction_audit, op12_conversation_structure_repair,
    op13_best_fit_packing)}
