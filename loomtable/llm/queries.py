"""One query for each corpus operator, over its whole table with production parameters, and SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtable.llm import bpe, fmindex, licenses, lm_score, merkle, mixing, nbsvm, quality, repair, rlz, simhash, templates, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = templates.drop_templates(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_score.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "n_tokens", *[F.round(c, 6).alias(c) for c in ("loss_target", "loss_background", "score")])


def op3_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_table(spark))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_rlz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def op6_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fmindex.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    proved = merkle.manifest(merkle.tampered(table(spark, sf_dir, "documents")), keep=("__claim",))
    return proved.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(F.transform("proof", lambda p: F.concat(p["before"], p["after"])), ""), 256).alias("proof_sha256"),
        merkle.fold(F.col("__claim"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audited(table(spark, sf_dir, "conversations"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    source = bpe.tokenizer_source(public_tokenizers.path("byte_bpe_50k.json"))
    both = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), source), source)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_templates": op1_line_templates,
    "op2_lm_score": op2_lm_score,
    "op3_license_digests": op3_license_digests,
    "op4_simhash": op4_simhash,
    "op5_rlz": op5_rlz,
    "op6_fm_index": op6_fm_index,
    "op7_quality_rules": op7_quality_rules,
    "op8_toxicity": op8_toxicity,
    "op9_mixing": op9_mixing,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_bpe": op13_bpe,
}

ORACLES: dict[str, str] = {
    "op1_line_templates": templates.SQL,
    "op2_lm_score": lm_score.SQL,
    "op3_license_digests": licenses.sql(),
    "op5_rlz": rlz.SQL,
    "op6_fm_index": fmindex.SQL,
    "op7_quality_rules": quality.SQL,
    "op11_merkle_manifest": merkle.SQL,
    "op12_conversation_repair": repair.SQL,
    "op9_mixing": mixing.SQL.format(docs="documents", keep="doc_id,"),
}
