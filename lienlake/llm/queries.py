"""The registered queries of the operators: each applies one to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (conversation_repair, decontamination, license_scan, line_dedup, mixing, ngram_join, packing, periodic_runs,
               quality_ensemble, quality_rules, secret_scan, suffix_dedup, toxicity)
from .common import read_table
from .query_sql import QUERY_SQL  # noqa: F401


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted")


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with a passage of 50 words or more that another document has too."""
    return suffix_dedup.passages_by_document(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    live = F.size(F.filter("spans", lambda s: s["live"])).cast("long")
    return secret_scan.scan(docs).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secret_scan.digest(F.col("spans"), secret_scan.BASE), 256).alias("base_sha256"),
        secret_scan.digest(F.col("spans")).alias("spans"), live.alias("n_live"))


def op4_quality_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    scored = quality_ensemble.score(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line that goes, with the line that stands for it."""
    found = line_dedup.duplicate_lines(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "line_no", "keep_doc_id", "keep_line_no", "edits")


def op6_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item whose passage it holds."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    items = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontamination.contaminated(docs, items).select("doc_id", "item_id", "first_word", "agreeing")


def op9_weighted_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return ngram_join.jaccard_components(docs).select("doc_id", "n_shingles", "component_id")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


def tokenizer_file() -> str:
    """The vocabulary that op11 packs with."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ("doc_id", "piece", "start", "length", "ids_crc32")
    found = packing.pieces(read_table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_file())
    return packing.pack(found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")).select(*cols, "sequence_id", "offset")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return conversation_repair.digest(rows, conversation_repair.repair(conversation_repair.damaged(rows)))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text").withColumn("text", periodic_runs.with_planted_runs())
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return periodic_runs.periodic_runs(docs).withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.p")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_secret_ownership": op3_secret_ownership,
    "op4_quality_ensemble": op4_quality_ensemble,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality_cascade": op6_quality_cascade,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_weighted_fair_mix": op9_weighted_fair_mix,
    "op10_license_scan": op10_license_scan,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_periodic_runs": op13_periodic_runs,
}
