"""The operators' queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.oracles import ORACLES


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.jaccard_join import jaccard_join

    return jaccard_join(_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.quality import quality_rules

    return quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.toxicity import score_toxicity

    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.html_text import extract_text

    return extract_text(_table(spark, sf_dir, "pages"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidemark.llm.bpe import bpe_digests

    return bpe_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.langid import identify_languages

    return identify_languages(_table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.embedding_dedup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.repeats import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.sharding import shard_documents

    return shard_documents(_table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.filter_audit import audit_filters

    return audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.warc import archive_pages

    return archive_pages(_table(spark, sf_dir, "pages"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.lexical_search import search

    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for name, f in sorted(globals().items()) if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
