"""Queries and SQL of the training-data operators, as __spark_entry__ registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridrisk.llm import (
    decontaminate,
    hard_negatives,
    hmm,
    language_id,
    licenses,
    near_dedup,
    packing,
    quality_classifier,
    quality_rules,
    sentencepiece_bpe,
    sharding,
    suffix_dedup,
    vector_codes,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": suffix_dedup.query,
        "op2_quality_classifier": quality_classifier.query,
        "op3_hmm_scoring": hmm.query,
        "op4_quality_rules": quality_rules.query,
        "op5_sharding": sharding.query,
        "op6_near_dedup": near_dedup.query,
        "op7_license_scan": licenses.query,
        "op8_decontamination": decontaminate.query,
        "op9_language_id": language_id.query,
        "op10_sentencepiece": sentencepiece_bpe.query,
        "op11_hard_negatives": hard_negatives.query,
        "op12_vector_codes": vector_codes.query,
        "op13_packing": packing.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_license_scan": licenses.SQL, "op8_decontamination": decontaminate.SQL, "op11_hard_negatives": hard_negatives.SQL, "op12_vector_codes": vector_codes.SQL}
