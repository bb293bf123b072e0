"""File scans for landed payloads.  Every reader takes an explicit schema (no
inference pass over the data) and returns a lazy DataFrame; directories are
read in parallel, one task per file split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow import schemas as SC


def read_json(spark: SparkSession, path: str, schema: str, multiline: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_records_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Search-API payloads with a top-level ``records`` array (one file per page)."""
    return read_json(spark, path, SC.SPRINGER_PAYLOAD).withColumn("_file", F.col("_metadata.file_path"))


def read_guardian_items(spark: SparkSession, path: str) -> DataFrame:
    """Landing directory of JSON files, each an array of articles (one row per element)."""
    return read_json(spark, path, SC.GUARDIAN_ITEM).withColumn("_file", F.col("_metadata.file_path"))


def read_scopus_items(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, SC.SCOPUS_ITEM).withColumns({"_file": F.col("_metadata.file_path"), "item_seq": F.monotonically_increasing_id()})


def read_crossref_items(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, SC.CROSSREF_ITEM)


def read_card_pages(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, SC.CARD_PAGE).withColumn("_file", F.col("_metadata.file_path"))


def read_rss(spark: SparkSession, path: str) -> DataFrame:
    """RSS/XML feeds (Spark's built-in XML source); the file path identifies the feed.

    One task reads a whole file, so ``item_seq`` grows with an item's position in its file.
    """
    return (
        spark.read.format("xml")
        .option("rowTag", "item")
        .schema(SC.RSS_ITEM)
        .load(path)
        .withColumns({"feed": F.col("_metadata.file_path"), "item_seq": F.monotonically_increasing_id()})
    )


def read_atom(spark: SparkSession, path: str) -> DataFrame:
    """Atom feeds: ``<entry>`` rows mapped onto the RSS item columns.

    The link is the ``rel="alternate"`` (or first) ``href``; the author is
    ``author/name``; ``published`` falls back to ``updated``.
    """
    raw = (
        spark.read.format("xml")
        .option("rowTag", "entry")
        .schema(SC.ATOM_ENTRY)
        .load(path)
        .withColumns({"feed": F.col("_metadata.file_path"), "item_seq": F.monotonically_increasing_id()})
    )
    alternate = F.filter("link", lambda l: F.coalesce(l["_rel"], F.lit("alternate")) == "alternate")
    href = F.coalesce(F.get(alternate, 0)["_href"], F.get(F.col("link"), 0)["_href"])
    return raw.select(
        "title",
        href.alias("link"),
        F.col("author.name").alias("author"),
        F.coalesce("published", "updated").alias("pubDate"),
        "updated",
        F.col("summary").alias("description"),
        "feed",
        "item_seq",
    )


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """RSS items and Atom entries of one landing folder; a file of the other kind gives no rows."""
    return read_rss(spark, path).unionByName(read_atom(spark, path), allowMissingColumns=True)


def read_deals_csv(spark: SparkSession, directory: str, prefix: str = "AxiosPro") -> DataFrame:
    """All ``<prefix>*.csv`` deal exports of a directory, unioned by the reader."""
    return spark.read.csv(f"{directory}/{prefix}*.csv", header=True, schema=SC.DEALS_RAW)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def require_columns(df: DataFrame, columns: list[str], name: str = "table") -> DataFrame:
    """Schema smoke check of a scanned table: it has columns and the required ones."""
    missing = [c for c in columns if c not in df.columns]
    if not df.columns or missing:
        raise ValueError(f"{name}: missing columns {missing or columns}")
    return df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path holds anything, asked of the file system that it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and len(fs.listStatus(p)) > 0
