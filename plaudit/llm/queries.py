"""Registered queries of the training-data operators: name to ``(spark, directory) -> DataFrame``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from plaudit.llm import centroid_clusters, collocations, decontaminate, jaccard_join, language_model, license_scan, mixing, oracle, personal_data, secrets, substring_dedup, token_files, toxicity, vector_dedup
from plaudit.session import ship_package
from plaudit.sources.adapter import table
from plaudit.storage import materialise, work_path

TOKENIZER = "word_bpe_49k.json"


def op1_benchmark_decontamination(spark, directory):
    ship_package(spark)
    docs = table(spark, directory, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, directory, "benchmark")).drop("text")
    return found.select(
        "doc_id", "n_words", decontaminate.hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def op2_substring_dedup(spark, directory):
    ship_package(spark)
    docs = table(spark, directory, "documents").select("doc_id", "text")
    found = substring_dedup.remove_repeats(docs).drop("text")
    return found.select(
        "doc_id", "n_words", decontaminate.hit_words().alias("n_removed"), "kept_sha256")


def op3_lm_scoring(spark, directory):
    ship_package(spark)
    return language_model.score_texts(table(spark, directory, "documents"))


def _joined_spans(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count_kind(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op4_secret_scan(spark, directory):
    ship_package(spark)
    docs = table(spark, directory, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs).drop("text")
    counts = [_count_kind("base_spans", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select(
        "doc_id", *counts, F.sha2(_joined_spans("base_spans"), 256).alias("base_sha256"),
        _joined_spans("spans").alias("spans"))


def op5_source_mixing(spark, directory):
    docs = table(spark, directory, "documents").select("doc_id", "source", "text")
    return mixing.taken_words(mixing.plan_mix(docs), ["doc_id"])


def op6_embedding_near_dedup(spark, directory):
    ship_package(spark)
    return vector_dedup.near_duplicates(table(spark, directory, "embeddings"))


def op7_license_scan(spark, directory):
    ship_package(spark)
    docs = table(spark, directory, "documents").select("doc_id", "text")
    found = license_scan.find_licenses(docs).drop("text")
    listed = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"], m["end"]))
    return found.select(
        "doc_id", "n_words", F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["coverage"])), F.lit(0.0)).alias("best_coverage"),
        F.array_join(listed, ",").alias("matches"))


def op8_ngram_jaccard_join(spark, directory):
    ship_package(spark)
    return jaccard_join.jaccard_join(table(spark, directory, "documents"))


def op9_toxicity(spark, directory):
    ship_package(spark)
    docs = table(spark, directory, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, table(spark, directory, "labels")).drop("text")
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


def op10_token_output(spark, directory):
    ship_package(spark)
    docs = table(spark, directory, "documents").select("doc_id", "text")
    path = work_path(spark, "tokens")
    token_files.write_tokens(docs, path, public_tokenizers.path(TOKENIZER))
    return token_files.read_tokens(spark, path)


def op11_personal_data(spark, directory):
    ship_package(spark)
    docs = table(spark, directory, "documents").select("doc_id", "text")
    found = personal_data.find_personal_data(docs).drop("text")
    counts = [_count_kind("base_spans", kind).alias(f"n_{kind}") for kind in personal_data.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(_joined_spans("base_spans"), 256).alias("base_sha256"),
        _joined_spans("spans").alias("spans"))


def op12_phrase_collocations(spark, directory):
    ship_package(spark)
    return collocations.mine_collocations(table(spark, directory, "documents").select("text", "lang"))


def op13_centroid_clusters(spark, directory):
    ship_package(spark)
    vectors = table(spark, directory, "embeddings").select("vec_id", "embedding")
    found = materialise(centroid_clusters.cluster_vectors(vectors).drop("embedding"), "clusters")
    return centroid_clusters.with_inertia(found).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_secret_scan": op4_secret_scan,
    "op5_source_mixing": op5_source_mixing,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_toxicity": op9_toxicity,
    "op10_token_output": op10_token_output,
    "op11_personal_data": op11_personal_data,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_centroid_clusters": op13_centroid_clusters,
}

ORACLE: dict[str, str] = {
    "op1_benchmark_decontamination": oracle.DECONTAMINATION,
    "op2_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op12_phrase_collocations": oracle.COLLOCATIONS,
    "op13_centroid_clusters": oracle.CENTROID_CLUSTERS,
}
