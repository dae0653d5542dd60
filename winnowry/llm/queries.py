"""One query per operator of this subpackage, over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, kdsearch, langid, linededup, neardup, packing, quality, secrets, spotsigs, token_store
from .common import documents, texts, tuned


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and all pages."""
    pages = tuned(spark).read.parquet(f"{sf_dir}/pages.parquet")
    return langid.identify(langid.evidence_of_documents(documents(spark, sf_dir)).unionByName(langid.evidence_of_pages(pages)))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), end_id=2)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir), words=2, percent=80)


def op5_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines that are not blank."""
    return linededup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), end_id=0, capacity=2048)


def op8_kd_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdsearch.top_inner_products(tuned(spark).read.parquet(f"{sf_dir}/embeddings.parquet"), k=5, every=50)


def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(documents(spark, sf_dir))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(texts(documents(spark, sf_dir))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op1_langid": op1_langid, "op2_token_store": op2_token_store, "op3_quality": op3_quality, "op4_minhash": op4_minhash, "op5_bpe_roundtrip": op5_bpe_roundtrip, "op6_line_dedup": op6_line_dedup, "op7_packing": op7_packing, "op8_kd_search": op8_kd_search, "op9_spotsigs": op9_spotsigs, "op10_secrets": op10_secrets}
SQL: dict[str, str] = {"op8_kd_search": kdsearch.oracle_sql(), "op10_secrets": secrets.oracle_sql()}
