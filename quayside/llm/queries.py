"""The registered queries of this package, each with production parameters over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.llm.common import table
from quayside.llm.oracles import SQL


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.suffix_dedup import suffix_query

    return suffix_query(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.sharding import shard_by_bytes

    return shard_by_bytes(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.mil_quality import quality_query

    return quality_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.simhash import simhash_query

    return simhash_query(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.html_blocks import extract_pages

    return extract_pages(table(spark, sf_dir, "pages"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.digest import digest_query

    return digest_query(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.pieces import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), "doc_id")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.quality_rules import quality_query

    return quality_query(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.mixing import mix_ledger

    return mix_ledger(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quayside.llm.pii import pii_query

    return pii_query(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}
    return dict(sorted(found.items(), key=lambda kv: int(kv[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
