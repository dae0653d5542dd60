"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
one's docs.  All stages but the last return the columns of documents.

1. language_id: documents without a letter, or whose language stays unclear, go.
2. line_dedup: of lines that are alike (0.8) one stays; a document that consists of repeated lines alone goes.
3. near_duplicates: of documents alike in their runs of five words (0.8) the one with the least doc_id stays.
4. secrets: keys, tokens and passwords are replaced by a mark.
5. packing: what is left is cut into pieces and packed into sequences of 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry.llm import langid, linededup, neardup, packing, secrets
from winnowry.llm.common import Scratch, tuned

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _counted(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tuned(spark)
    return langid.accepted(docs.select(*COLUMNS))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tuned(spark)
    found = linededup.dedup_lines(docs.select(*COLUMNS))
    return _counted(found.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"\S")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tuned(spark)
    return neardup.deduplicated(docs.select(*COLUMNS), words=5, percent=80)


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(secrets.redact(docs.select(*COLUMNS)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tuned(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0, capacity=2048)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("secrets", scan_secrets), ("packing", pack)]

#: Connected components and packing have no form in SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every other stage is written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
