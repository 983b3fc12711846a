"""Registered queries of the operators and the DuckDB SQL of those that SQL
expresses. Each reads its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import oracles
from tessera.llm.alignment import alignments
from tessera.llm.common import Scratch
from tessera.llm.exact_dedup import exact_duplicates
from tessera.llm.main_text import main_texts
from tessera.llm.mixing import mixed
from tessera.llm.near_dedup import near_duplicates
from tessera.llm.prefix_trie import prefix_trie
from tessera.llm.quality import judged
from tessera.llm.secrets import report, scan
from tessera.llm.sentencepieces import read_model, round_trip
from tessera.llm.substring_dedup import remove_repeats
from tessera.llm.token_counts import token_counts
from tessera.llm.url_filter import ALLOW, BLOCK, PrefixRule, host_of, judge_urls
from tessera.llm.warc import archived


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# The prefix rules, and the sites whose pages the list of URLs holds.
URL_RULES = [PrefixRule(ALLOW, "com", "/"), PrefixRule(BLOCK, "example.com", "/en/"), PrefixRule(ALLOW, "www.example.com", "/en/"),
             PrefixRule(BLOCK, "net", "/es/"), PrefixRule(BLOCK, "net", "/fr/")]
LISTED_SITES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_MODEL = "byte_bpe_50k.json"


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the URLs of all pages of the listed sites, so it grows
    with the table."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(host_of(F.col("url")).rlike(rf"(^|\.)({'|'.join(LISTED_SITES)})\."))
    return judge_urls(pages, listed, URL_RULES)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(_read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "quality.*")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(_read(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(_read(spark, sf_dir, "pages"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_read(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(*scan(_read(spark, sf_dir, "documents")))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache of its own, so every call does all the work."""
    cache = Scratch(spark, "token-cache").path("counts")
    return token_counts(_read(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL), cache)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_read(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_read(spark, sf_dir, "documents"), read_model(public_tokenizers.path(PIECE_MODEL)))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(_read(spark, sf_dir, "pages"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(_read(spark, sf_dir, "documents"), read_model(public_tokenizers.path(BYTE_MODEL)),
                      read_model(public_tokenizers.path(PIECE_MODEL)))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(_read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filter, op2_quality_rules, op3_source_mixing, op4_html_extraction, op5_minhash_near_dedup,
                            op6_substring_dedup, op7_secret_scan, op8_token_counts, op9_exact_dedup, op10_sentencepiece,
                            op11_warc, op12_token_alignment, op13_prefix_trie)
}
ORACLE: dict[str, str] = {"op1_url_filter": oracles.op1(URL_RULES, LISTED_SITES), **oracles.SQL}
