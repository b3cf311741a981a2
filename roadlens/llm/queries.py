"""Queries of the corpus operators, one per operator and the pipeline, with DuckDB SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from roadlens.llm import (
    collocations,
    decontaminate,
    extraction,
    fingerprints,
    hard_negatives,
    mixing,
    near_dedup,
    quality,
    sharding,
    substrings,
    toxicity,
    url_filter,
    warc,
)
from roadlens.llm.common import table


def _over(name: str, operator: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_html_extraction": _over("pages", extraction.op1_html_extraction),
        "op4_warc_packages": _over("pages", warc.op4_warc_packages),
        "op8_fingerprints": _over("documents", fingerprints.op8_fingerprints),
        "op6_toxicity": lambda spark, sf_dir: toxicity.op6_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
        "op9_quality_classifier": lambda spark, sf_dir: quality.op9_quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
        "op3_substring_dedup": _over("documents", substrings.op3_substring_dedup),
        "op10_minmax_near_dedup": _over("documents", near_dedup.op10_minmax_near_dedup),
        "op2_source_mixing": _over("documents", mixing.op2_source_mixing),
        "op7_benchmark_decontamination": lambda spark, sf_dir: decontaminate.op7_benchmark_decontamination(
            table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
        ),
        "op5_hilbert_sharding": _over("documents", sharding.op5_hilbert_sharding),
        "op11_url_model_ratio": _over("pages", url_filter.op11_url_model_ratio),
        "op12_hard_negatives": _over("embeddings", hard_negatives.op12_hard_negatives),
        "op13_phrase_collocations": _over("documents", collocations.op13_phrase_collocations),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_source_mixing": mixing.SQL,
        "op3_substring_dedup": substrings.SQL,
        "op4_warc_packages": warc.SQL,
        "op7_benchmark_decontamination": decontaminate.SQL,
        "op10_minmax_near_dedup": near_dedup.SQL,
        "op11_url_model_ratio": url_filter.SQL,
        "op12_hard_negatives": hard_negatives.SQL,
        "op13_phrase_collocations": collocations.SQL,
    }
