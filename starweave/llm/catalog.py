"""The registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import read_table
from . import (
    decontaminate,
    fill_middle,
    jaccard_join,
    mixing,
    page_text,
    pieces,
    pseudonyms,
    quality,
    sharding,
    tokens,
    toxicity,
    url_lists,
    vector_codes,
)


#: The registered query's key; a deployment passes its own secret.
DEMO_KEY = "starweave-demo-key"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(read_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(read_table(spark, sf_dir, "documents"), DEMO_KEY)


def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.main_text(read_table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(read_table(spark, sf_dir, "documents"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return url_lists.evaluate(url_lists.derived_captures(pages), url_lists.derived_changes(pages))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(read_table(spark, sf_dir, "documents")).select(*quality.QUERY_COLUMNS)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(read_table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(read_table(spark, sf_dir, "documents")))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(read_table(spark, sf_dir, "embeddings"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(pieces.decode(pieces.encode(read_table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_token_counts, op2_decontamination, op3_toxicity, op4_pseudonyms, op5_page_text, op6_mixing, op7_url_filters,
    op8_quality_rules, op9_sharding, op10_jaccard_join, op11_fill_middle, op12_vector_codes, op13_sentencepiece)}
ORACLES: dict[str, str] = {
    "op6_mixing": mixing.ORACLE, "op7_url_filters": url_lists.ORACLE, "op8_quality_rules": quality.ORACLE,
    "op11_fill_middle": fill_middle.ORACLE, "op12_vector_codes": vector_codes.ORACLE}
