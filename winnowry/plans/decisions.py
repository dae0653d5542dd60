"""One table that says of every document what became of it; every statistic and file is a query over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import split_of, text_hash
from ..functions.signals import rule_signals
from ..functions.text import clean
from ..operators.dedup import dedup
from ..operators.rules import reason_of
from ..operators.sampling import slot, with_ordinal
from ..scratch import Scratch
from ..settings import Settings


def inspected(rows: DataFrame, settings: Settings) -> DataFrame:
    """Row by row, without a shuffle: raw, text (cleaned), reason (of cleaning and rules), text_hash."""
    raw = rows.withColumnRenamed("text", "raw").withColumn("text", clean(F.col("raw")))
    reason = reason_of(F.col("raw"), F.col("text"), rule_signals(F.col("text")), settings.min_chars, settings.max_chars, settings.policy, settings.thresholds)
    return raw.withColumn("reason", reason).withColumn("text_hash", F.when(F.col("reason").isNull(), text_hash(F.col("text"))))


def decide(rows: DataFrame, settings: Settings, assume_unique_ids: bool | None = None, texts: bool = True) -> DataFrame:
    """seq, id, domain, raw, text, text_hash, character_count, reason, i, slot, retained, split.

    The cleaned rows are written once.  What decides (ids and hashes) goes through the shuffles without texts.
    ``texts``: whether raw and text are among the columns; for statistics they are not even written.
    """
    scratch = Scratch(rows.sparkSession, "decisions")
    both = ("raw", "text") if texts else ()
    first = inspected(rows, settings).withColumn("character_count", F.length("text").cast("long"))
    first = scratch.table(first.select("seq", "id", "domain", *both, "text_hash", "character_count", "reason"), "inspected")
    keys = first.filter("reason is null").select("seq", "id", "text_hash")
    after = dedup(keys, assume_unique_ids).select("seq", "duplicate")
    after = scratch.table(after, "duplicates")
    # The place among candidates, and the slot it is sent to
    places = with_ordinal(after.filter("duplicate is null").select("seq"), "seq", "i").withColumn("slot", slot(F.col("i"), settings.max_documents, settings.seed))
    winners = places.filter(F.col("slot") < settings.max_documents).groupBy("slot").agg(F.max("i").alias("i")).select("i", F.lit(True).alias("_won"))
    light = after.join(places, "seq", "left").join(winners, "i", "left").select("seq", "duplicate", "i", "slot", F.coalesce("_won", F.lit(False)).alias("retained"))
    out = first.join(light, "seq", "left").withColumn("reason", F.coalesce("reason", "duplicate")).withColumn("retained", F.coalesce("retained", F.lit(False)))
    split = F.when(F.col("retained"), split_of(F.col("id"), settings.seed, settings.train_ratio, settings.val_ratio))
    return out.select("seq", "id", "domain", *both, "text_hash", "character_count", "reason", "i", "slot", "retained", split.alias("split"))
