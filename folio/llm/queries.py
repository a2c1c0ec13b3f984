"""The registered ``opN_`` queries: each applies its operator to its whole table."""

from __future__ import annotations

import re
import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import (decontaminate, embedding_dedup, html_extract, jaccard_join, line_dedup, lm_score,
                       merkle_manifest, mixing, periodic_runs, quality_rules, substring_dedup, token_counts, token_output)
from folio.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A fresh shared folder, as a URI for readers and writers other than Spark's."""
    return re.sub(r"^(?:file:)?/+", "file:///", scratch_path(spark, name))


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a sequence, with its slot and its record; the shards are written on the way."""
    return token_output.materialise(table(spark, sf_dir, "documents"), shards=scratch_uri(spark, "shards"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts before and after masking, the latter from the edited trees."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = token_counts.mask_edits(token_counts.build_trees(docs))
    return token_counts.update_trees(trees).select(
        "doc_id", F.col("_tree")[1].cast("long").alias("n_tokens"),
        F.size("_edits").cast("long").alias("n_edits"),
        F.col("_new_tree")[1].cast("long").alias("n_tokens_edited"),
        F.size("_new_chars").cast("long").alias("n_segments"), F.col("_encoded").alias("n_encoded_again"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    judged = quality_rules.judge(docs, rules, keep=["doc_id"])
    return judged.select("doc_id", *[F.col(f"_{s}").alias(s) for s in quality_rules.STATS],
                         F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"),
                         F.col("_rule").alias("rule"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = html_extract.extract(table(spark, sf_dir, "pages"))
    return extracted.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_shared")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.cut_repeats(docs).select(
        "doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"),
        F.sha2("_kept_text", 256).alias("kept_sha256"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that it copies."""
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document, and the position of its first reading, in the order of these positions."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.schedule(docs).select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), F.col("_taken").alias("taken"),
        F.get("_positions", F.lit(0)).alias("first_position"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every text; in every tenth document, by hash, the words from some place on are made periodic first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)
    n, g = F.size("words"), F.floor(h / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    index = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i >= a, a + (i - a) % p).otherwise(i))
    planted = F.array_join(F.transform(index, lambda i: F.get("words", i.cast("int"))), " ")
    docs = (docs.withColumn("words", F.when(h % 10 == 0, words))
            .select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text")))
    run = F.col("run")
    return (periodic_runs.find_runs(docs).withColumn("run", periodic_runs.longest("_runs"))
            .select("doc_id", F.size("_runs").cast("long").alias("n_runs"), run["start"].alias("start"),
                    run["length"].alias("length"), run["period"].alias("period"),
                    F.floor(1000 * run["length"] / run["period"]).alias("exponent_milli"),
                    F.sha2(periodic_runs.listing("_runs"), 256).alias("runs_sha256"),
                    F.sha2("_collapsed", 256).alias("collapsed_sha256")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, and the root folded from it; a third of the texts is tampered with first."""
    docs = table(spark, sf_dir, "documents")
    others = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = merkle_manifest.leaf_hash(*others, F.col("text"))
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0,
                      merkle_manifest.leaf_hash(*others, lowered)).otherwise(leaf)
    leaves = docs.select("doc_id", "lang", leaf.alias("leaf"), tampered.alias("seen"))
    manifest = merkle_manifest.build(leaves, "lang", "doc_id", "leaf", keep=["doc_id", "seen"])
    return (merkle_manifest.proofs(manifest)
            .select("doc_id", "leaf", "subroot", "root", merkle_manifest.path_hash("path").alias("proof_sha256"),
                    merkle_manifest.fold("seen", "path").alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_output": op1_token_output,
    "op2_token_counts": op2_token_counts,
    "op3_quality_rules": op3_quality_rules,
    "op4_html_extraction": op4_html_extraction,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_decontamination": op8_decontamination,
    "op9_mixing": op9_mixing,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_merkle_manifest": op13_merkle_manifest,
}
