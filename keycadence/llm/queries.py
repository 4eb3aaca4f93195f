"""Named queries of the subpackage, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import (
    ann,
    audit,
    bpe,
    clustering,
    licences,
    lm,
    mixing,
    neardup,
    packing,
    passages,
    pii,
    quality,
    warc,
)
from .shipping import ship


def _read(spark, sf_dir, name):
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark, sf_dir):
    report = quality.quality_report(_read(spark, sf_dir, "documents"))
    return report.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op2_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.round_trip(docs, path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_personal_data(spark, sf_dir):
    found = pii.found_spans(_read(spark, sf_dir, "documents"), ["doc_id"])
    kinds = F.transform("base", lambda x: x["kind"])
    counts = {
        f"n_{kind}": (F.size("base") - F.size(F.array_remove(kinds, k))).cast("long")
        for k, kind in enumerate(pii.KINDS)
    }
    return found.withColumns(counts).select(
        "doc_id",
        *counts,
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )


def op4_nearest_neighbours(spark, sf_dir):
    return ann.nearest(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_best_fit_packing(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.packed_documents(_read(spark, sf_dir, "documents"), path)


def op6_lm_scoring(spark, sf_dir):
    return lm.text_scores(_read(spark, sf_dir, "documents"))


def op7_warc(spark, sf_dir):
    return warc.archived(_read(spark, sf_dir, "pages")).drop("payload")


def op8_minhash_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(_read(spark, sf_dir, "documents"), width=4)


def op9_license_scan(spark, sf_dir):
    found = licences.license_scan(_read(spark, sf_dir, "documents"))
    best = F.array_max(F.transform("licenses", lambda x: x["dice"]))
    return found.select(
        "doc_id",
        F.concat_ws(
            ",", F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["license"])))
        ).alias("licenses"),
        F.size("licenses").cast("long").alias("n_matches"),
        F.round(best, 6).alias("best_dice"),
    )


def op10_substring_dedup(spark, sf_dir):
    return passages.repeated_passages(_read(spark, sf_dir, "documents"))


def op11_filter_audit(spark, sf_dir):
    return audit.filter_audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op12_source_mixing(spark, sf_dir):
    first = F.get("reads", F.lit(0))["position"]
    return mixing.mixed(_read(spark, sf_dir, "documents")).select(
        "doc_id", "source", "size", "source_size", "target", "taken",
        F.round(first, 6).alias("first_position"),
    )


def op13_centroid_clustering(spark, sf_dir):
    return clustering.centroid_clusters(_read(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_personal_data": op3_personal_data,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_warc": op7_warc,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_license_scan": op9_license_scan,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_source_mixing": op12_source_mixing,
    "op13_centroid_clustering": op13_centroid_clustering,
}
