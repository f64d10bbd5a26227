"""The operators of this subpackage as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txnscore.llm import codes, common, divergence, exact_dedup, fingerprints, languages, licenses, mixing, near_dedup, pieces, quality, repeats, reputation, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _over_documents(operator: Callable[[SparkSession, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(spark, common.documents(spark, sf_dir))


def _over(table: str, operator: Callable[[SparkSession, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(spark, spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def _over_labelled_documents(operator: Callable[[SparkSession, DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(spark, common.documents(spark, sf_dir), common.labels(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": _over_documents(repeats.op1_suffix_dedup),
    "op2_exact_dedup": _over_documents(exact_dedup.op2_exact_dedup),
    "op3_language_id": _over_documents(languages.op3_language_id),
    "op4_mixing": _over_documents(mixing.op4_mixing),
    "op5_sentencepiece": _over_documents(pieces.op5_sentencepiece),
    "op6_toxicity": _over_labelled_documents(toxicity.op6_toxicity),
    "op7_fingerprints": _over_documents(fingerprints.op7_fingerprints),
    "op8_quality": _over_labelled_documents(quality.op8_quality),
    "op9_license_scan": _over_documents(licenses.op9_license_scan),
    "op10_near_dedup": _over_documents(near_dedup.op10_near_dedup),
    "op11_url_filter": _over("pages", reputation.op11_url_filter),
    "op12_vector_codes": _over("embeddings", codes.op12_vector_codes),
    "op13_source_divergence": _over_documents(divergence.op13_source_divergence),
}
