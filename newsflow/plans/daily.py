"""The daily compile as one lazy plan: union → new titles → one row a title → tag → clean → content tags.

Exchanges appear only where the semantics need them: the anti-join against the
stored titles and the title dedup, the (content_id, guid) dedup and the
programme roll-up (keyed on content id).  Tagging, cleaning and the wide→long
reshape are narrow, and only new articles are tagged.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.operators.clean import clean_articles, stored_title
from newsflow.operators.dedup import keep_first
from newsflow.operators.key_index import KeyIndex
from newsflow.operators.load import new_rows
from newsflow.operators.tagging import char_limit, tag_articles, with_description_fallback
from newsflow.operators.tags_long import tag_transform
from newsflow.operators.versioned import VersionedTable
from newsflow.schemas import ARTICLE, ARTICLE_COLUMNS


@dataclass
class DailyResult:
    new_articles: DataFrame
    content_tags: DataFrame
    profile_updates: DataFrame


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Union by name over the union of columns; missing columns become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    for c in ARTICLE_COLUMNS:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(ARTICLE[c].dataType))
    return out


def assign_ids(df: DataFrame, content: DataFrame, key: str = "title") -> DataFrame:
    """Unique new ids above the stored maximum without a global sort.

    Rows are hash-partitioned by the unique ``key`` into a fixed number of
    partitions and sorted within each, so every partition holds the same rows
    in the same order however the shuffle blocks arrive;
    ``monotonically_increasing_id`` (partition index, position) is then
    reproduced exactly when a lost task is recomputed.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = content.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).scalar()
    ordered = df.repartition(n, key).sortWithinPartitions(key, *[c for c in df.columns if c != key])  # cut titles can tie
    return ordered.withColumn("id", base + 1 + F.monotonically_increasing_id())


def compile_new_articles(
    incoming: DataFrame,
    content: DataFrame,
    ref_tags: DataFrame,
    order: list[str | Column],
    excluded_sources: list[str] | None = None,
    keep: list[str] | None = None,
    cap: int | Column | None = None,
    index: KeyIndex | None = None,
    before_epoch: int | None = None,
) -> DataFrame:
    """Stages 3–7: of the day's union, the titles not stored yet (case-insensitive), tagged and cleaned.

    The text cap is that of the whole union unless given.  All copies of a raw
    title share one cleaned title and so the same fate in the anti join, so the
    join comes first, then the dedup, and only what survives is tagged.  The
    dedup groups by the raw title, not by the key of the join: its own
    exchange, behind a map-side combine, leaves AQE free to split a hot title
    in the join.  With an ``index`` of the stored titles (``stored_titles``)
    only the new rows are exchanged for the join, and ``content`` isn't read.
    """
    rows = with_description_fallback(incoming).where(F.col("title").isNotNull())
    cap = char_limit(with_description_fallback(incoming)) if cap is None else cap
    rows = rows.withColumn("_stored_title", stored_title("title"))
    if index is None:
        stored = content.select(F.col("title").alias("_stored_title"))
        fresh = new_rows(rows, stored, ["_stored_title"], case_insensitive=True)
    else:
        fresh = index.new_rows(rows, before_epoch)
    tagged = tag_articles(keep_first(fresh.drop("_stored_title"), ["title"], order), ref_tags, cap=cap)
    return clean_articles(tagged, keep=keep, excluded_sources=excluded_sources, dedup=False).drop("_raw_title")


def stored_titles(spark: SparkSession, table: str, path: str, content: DataFrame | None = None, buckets: int | None = None) -> KeyIndex:
    """The index of stored titles under ``path``; made from ``content``, or attached to where that is None."""
    index = KeyIndex(spark, table, path, ["_stored_title"], case_insensitive=True, buckets=buckets)
    if content is None:
        index.attach()
    else:
        index.append(content.select(F.col("title").alias("_stored_title")))
    return index


def write_back_profiles(table: VersionedTable, rollup: DataFrame) -> int:
    """Merge (content_id, profiles) into the table of the contents' profiles: one version, touched buckets only."""
    rows = rollup.select(F.col("content_id").alias(table.key), "profiles")
    if not table.versions():
        return table.overwrite(rows)
    return table.upsert(rows)


def run_daily(
    incoming: DataFrame,
    content_path: str,
    content_tags_path: str,
    staging_path: str,
    ref_tags: DataFrame,
    profiles: DataFrame,
    order: list[str | Column],
    excluded_programmes: Sequence[str] = (),
    profile_table: VersionedTable | None = None,
) -> DailyResult:
    """The daily job with its stage boundaries written out.

    1. new articles (with ids) are written to ``staging_path`` – a written
       table in the shared storage cuts the lineage, so the tag transform reads
       exactly the rows and ids that were stored;
    2. they are appended to the content table;
    3. content tags and programme updates are derived for every tagged article
       of the content table that has no content tags yet (an anti join on ids),
       and appended / returned.  A run that stopped after step 2 is therefore
       made up for by the next one;
    4. with a ``profile_table`` the programme roll-up is merged into it by id
       before the content tags are appended, so no day's updates are lost: a
       run that stopped in between repeats a merge that changes nothing.
    Each write is a whole-stage action on a deterministic input, so a lost
    executor only recomputes its tasks.
    """
    spark = incoming.sparkSession
    content = spark.read.parquet(content_path)
    stored_tags = spark.read.parquet(content_tags_path)
    new = assign_ids(compile_new_articles(incoming, content, ref_tags, order, keep=list(order)), content)
    new.drop(*[c for c in order if isinstance(c, str)]).write.mode("overwrite").parquet(staging_path)
    staged = spark.read.parquet(staging_path)
    staged.write.mode("append").parquet(content_path)
    tag_rows, rollup = tag_transform(spark.read.parquet(content_path), stored_tags, ref_tags, profiles, excluded_programmes)
    rollup.write.mode("overwrite").parquet(f"{staging_path}-profiles")  # before the tags: they decide what is new
    if profile_table is not None:
        write_back_profiles(profile_table, spark.read.parquet(f"{staging_path}-profiles"))
    tag_rows.write.mode("append").parquet(content_tags_path)
    return DailyResult(spark.read.parquet(staging_path), spark.read.parquet(content_tags_path), spark.read.parquet(f"{staging_path}-profiles"))
