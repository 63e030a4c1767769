"""Registered queries of these operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logtide.llm.common import read_table
from logtide.llm.oracles import ORACLES as ORACLES
from logtide.llm.exact_topk import exact_topk
from logtide.llm.filter_audit import filter_audit
from logtide.llm.licenses import license_scan
from logtide.llm.mixing import mix_report
from logtide.llm.packing import pack
from logtide.llm.pair_ranker import pair_ranker
from logtide.llm.phrase_dedup import substring_dedup
from logtide.llm.prefix_trie import prefix_trie
from logtide.llm.quality_rules import quality_rules
from logtide.llm.secret_scan import samples, secret_scan, train
from logtide.llm.simhash import near_duplicates
from logtide.llm.style_tree import main_text
from logtide.llm.token_counts import token_counts


def op1_pair_ranker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_ranker(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return exact_topk(vectors, vectors.where("vec_id % 100 = 0"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read_table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return secret_scan(docs, train(samples(docs)))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(read_table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pair_ranker": op1_pair_ranker,
    "op2_exact_topk": op2_exact_topk,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_style_tree": op4_style_tree,
    "op5_quality_rules": op5_quality_rules,
    "op6_secret_scan": op6_secret_scan,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_source_mixing": op8_source_mixing,
    "op9_license_scan": op9_license_scan,
    "op10_token_counts": op10_token_counts,
    "op11_filter_audit": op11_filter_audit,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}
