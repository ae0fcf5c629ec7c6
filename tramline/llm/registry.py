"""The registered query of each operator: production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tramline.llm.common import table
from tramline.llm.op1_secrets import digest, scan_secrets
from tramline.llm import op8_embedding_dedup as embeddings
from tramline.llm import op10_jaccard_join as jaccard
from tramline.llm.op2_token_codes import token_codes
from tramline.llm.op3_url_filters import url_verdicts
from tramline.llm.op4_token_counts import token_counts
from tramline.llm.op5_decontamination import leaks
from tramline.llm.op6_resharding import resharded
from tramline.llm.op7_packing import pack
from tramline.llm.op9_toxicity import fit, toxicity
from tramline.llm import op11_source_divergence as sources
from tramline.llm import op13_importance_resampling as resampling
from tramline.llm.op12_byte_bpe import digests


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan_secrets(table(spark, sf_dir, "documents")))


def op2_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_codes(table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_min_cost_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resharded(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.source_divergence(table(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_secret_scans, op2_token_codes, op3_url_filters, op4_token_counts, op5_benchmark_decontamination,
                            op6_min_cost_flow_resharding, op7_best_fit_packing, op8_embedding_near_dedup, op9_toxicity, op10_ngram_jaccard_join,
                            op11_source_divergence, op12_byte_bpe, op13_importance_resampling)
}
ORACLE: dict[str, str] = {"op8_embedding_near_dedup": embeddings.ORACLE, "op10_ngram_jaccard_join": jaccard.ORACLE,
                          "op11_source_divergence": sources.ORACLE, "op13_importance_resampling": resampling.ORACLE}
