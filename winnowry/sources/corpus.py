"""Reading corpora: files in order, with an explicit position for every row, in the columns seq, id, domain, text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import from_json_string
from ..operators.sampling import with_ordinal
from ..settings import SPLITS, Settings


def hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_shards(spark: SparkSession, path: str, split: str | None = None) -> list[str]:
    """The Parquet files below ``path`` (or its folder data), sorted by name; only a split's, if one is named."""
    found: list[str] = []
    for folder in (path, f"{path}/data"):
        p, fs = hadoop_path(spark, folder)
        if fs.exists(p):
            found += [str(s.getPath()) for s in fs.listStatus(p) if s.isFile() and s.getPath().getName().endswith(".parquet")]
    if split:
        found = [f for f in found if re.match(rf"{re.escape(split)}(-|\.|$)", f.rsplit("/", 1)[1])]
    if not found:
        raise FileNotFoundError(f"no Parquet shards in {path}")
    return sorted(found, key=lambda f: f.rsplit("/", 1)[1])


def adapted(rows: DataFrame, settings: Settings) -> DataFrame:
    """seq (from 0), id, domain, text.  A column that is absent gets a default, a null in one that is there reads None."""
    have = set(rows.columns)
    absent = lambda c: c not in have
    text = F.lit(None).cast("string") if absent(settings.text_field) else F.col(settings.text_field).cast("string")
    domain = F.lit("unknown") if absent(settings.domain_field) else F.coalesce(F.col(settings.domain_field).cast("string"), F.lit("None"))
    seq = F.col("seq").cast("long")
    doc_id = F.concat(F.lit("missing_"), seq.cast("string")) if absent(settings.id_field) else F.coalesce(F.col(settings.id_field).cast("string"), F.lit("None"))
    return rows.select(seq.alias("seq"), doc_id.alias("id"), domain.alias("domain"), text.alias("text"))


def read_shards(spark: SparkSession, paths: list[str], settings: Settings) -> DataFrame:
    """Rows of Parquet files in the files' order by name, then in the order within a file.  Inputs are never deleted."""
    order = F.struct(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("f"), F.col("_metadata.row_index").alias("r"))
    rows = spark.read.parquet(*paths).select("*", order.alias("_at"))
    ranked = with_ordinal(rows, "_at", "_i").withColumn("seq", F.col("_i") - 1).drop("_at", "_i")
    return adapted(ranked, settings)


def read_source(spark: SparkSession, settings: Settings) -> DataFrame:
    """The source that the settings name: shards (a revision must be pinned) or any folder or file of Parquet or JSON."""
    try:
        if settings.loader == "shards":
            if not settings.revision:
                raise ValueError("reading shards needs a pinned revision")
            rows = read_shards(spark, list_shards(spark, settings.source, settings.source_split), settings)
        elif settings.source.endswith((".json", ".jsonl", ".json.gz", ".jsonl.gz")):
            # the order of lines is kept by a position that grows with file and line
            raw = spark.read.json(settings.source).withColumn("_at", F.monotonically_increasing_id())
            rows = adapted(with_ordinal(raw, "_at", "_i").withColumn("seq", F.col("_i") - 1), settings)
        else:
            rows = read_shards(spark, [settings.source], settings)
    except (ValueError, FileNotFoundError):
        raise
    except Exception as e:
        raise RuntimeError(f"can't read {settings.source!r}: {e}") from e
    return scan_limited(rows, settings.scan_limit)


def scan_limited(rows: DataFrame, limit: int | None) -> DataFrame:
    """The first rows by position; a bare limit would take any."""
    return rows if not limit else rows.filter(F.col("seq") < limit)


def read_splits(spark: SparkSession, processed: str) -> DataFrame:
    """The split files of a release that exist: their columns, split, and pos (split by split, row by row)."""
    found = None
    for k, split in enumerate(SPLITS):
        path = f"{processed}/{split}.parquet"
        p, fs = hadoop_path(spark, path)
        if not fs.exists(p):
            continue
        # a split is one file, so the row index is the place in it
        rows = spark.read.parquet(path).select("id", "domain", "text", "text_hash", "character_count", F.lit(split).alias("split"), (F.lit(k).cast("long") * (1 << 40) + F.col("_metadata.row_index")).alias("pos"))
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        raise FileNotFoundError(f"no split files in {processed}")
    return found


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """text and malformed of each line; only line feeds part lines.  Columns line (from 0, for one file), value, text."""
    rows = spark.read.option("lineSep", "\n").text(path).withColumn("_at", F.monotonically_increasing_id())
    return with_ordinal(rows, "_at", "_i").select((F.col("_i") - 1).alias("line"), "value", from_json_string(F.col("value")).alias("text"))


def read_distribution(spark: SparkSession, path: str) -> DataFrame:
    """domain, inspected, accepted from a CSV with a header; quotes are heeded."""
    return spark.read.option("header", True).option("escape", '"').schema("domain string, inspected long, accepted long").csv(path)
