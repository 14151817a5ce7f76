"""The registered queries of the numbered operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm import decontamination, jaccard_join, langid, near_dedup, neighbours, packing, secrets, spelling, sql, suffix_arrays, suffix_trees, toxicity, urls, vector_codes
from spanloom.session import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Fixed values of the url rules: (verdict, host and path).
URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op2_suffix_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_trees.digest(table(spark, sf_dir, "documents"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_arrays.digest(table(spark, sf_dir, "documents"))


def op4_multi_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.digest(table(spark, sf_dir, "embeddings"))


def op5_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.digest(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest(table(spark, sf_dir, "documents"))


def op10_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.digest(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digest(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.digest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_url_filter, op2_suffix_tree_dedup, op3_suffix_array_dedup, op4_multi_index_search, op5_winnowing_decontamination, op6_toxicity, op7_minhash_near_dedup, op8_secret_scan, op9_language_id, op10_sequence_packing, op11_jaccard_join, op12_vector_codes, op13_spelling_variants)}


def oracle_sql() -> dict[str, str]:
    return {"op2_suffix_tree_dedup": sql.OP2, "op3_suffix_array_dedup": sql.OP3, "op5_winnowing_decontamination": sql.OP5, "op7_minhash_near_dedup": sql.OP7, "op11_jaccard_join": sql.OP11, "op12_vector_codes": sql.OP12, "op13_spelling_variants": sql.OP13}
