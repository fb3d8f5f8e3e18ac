"""The operators bound to the given tables: one query for each, and the whole pipeline's SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm import (
    chat,
    collocations,
    decontam,
    exact_dedup,
    html_extract,
    language_id,
    license_scan,
    mixing,
    ranked_search,
    simhash,
    token_counts,
    token_store,
    toxicity,
)
from furrow.llm.common import shared_folder, table

TOKEN_FILE = "word_bpe_49k.json"
UNIGRAM_FILE = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    """Place of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_and_read(
        table(spark, sf_dir, "documents"), shared_folder(spark, "token-store"), tokenizer_path(TOKEN_FILE))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(UNIGRAM_FILE))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_license_scan, op2_html_extract, op3_language_id, op4_exact_dedup, op5_mixing, op6_chat_format, op7_simhash_dedup,
        op8_token_store, op9_decontaminate, op10_token_counts, op11_toxicity,
        op12_ranked_search, op13_collocations)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": license_scan.oracle_sql(),
        "op2_html_extract": html_extract.ORACLE,
        "op4_exact_dedup": exact_dedup.ORACLE,
        "op5_mixing": mixing.oracle_sql(),
        "op6_chat_format": chat.ORACLE,
        "op9_decontaminate": decontam.ORACLE,
        "op12_ranked_search": ranked_search.ORACLE,
        "op13_collocations": collocations.ORACLE,
    }
