"""One query for each operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from moraine.llm import ann, decontaminate, hard_negatives, html_extract, license_scan, near_dedup, packing, secret_scan, sentencepiece_lattice, sharding, spelling_variants, substring_dedup, toxicity
from moraine.llm.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), shards=16)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(table(spark, sf_dir, "documents"))


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_texts(table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_lattice.encode(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf_dir, "documents"), percent=85)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": op1_sharding,
        "op2_license_scan": op2_license_scan,
        "op3_ann": op3_ann,
        "op4_html_extraction": op4_html_extraction,
        "op5_toxicity": op5_toxicity,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_decontamination": op8_decontamination,
        "op9_packing": op9_packing,
        "op10_near_dedup": op10_near_dedup,
        "op11_secret_scan": op11_secret_scan,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_spelling_variants": op13_spelling_variants,
    }
