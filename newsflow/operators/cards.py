"""Knowledge cards: nested board pages → card rows → (title, tag, guid) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions import text as X
from newsflow.operators.dedup import keep_first
from newsflow.operators.joins import broadcast_if_small
from newsflow.operators.partitioning import posexplode_rows

# Card columns as (output, column title, position, attribute).
CARD_FIELDS = [
    ("status", "Status", 0, "value"),
    ("link", "Link to page", 1, "value"),
    ("date", "Date Published", 2, "value"),
    ("brief", "Brief Card Description", 3, "value"),
    ("tags", "Choose Tags", 4, "text"),
]
# Extraction patterns for URL, ISO date and text from the first letter.
URL_PATTERN = r"(https?://[A-Za-z0-9$-_@.&+!*\\(),]+)"
DATE_PATTERN = r"(\d{4}-\d{2}-\d{2})"
TEXT_PATTERN = r"([A-Za-z].*)"


def _field(column_values: Column, title: str, pos: int, attr: str) -> Column:
    """Value of the column with this title; the position is only a fallback (Q20).

    ``array_position`` over the extracted title array keeps the lookup in
    generated code (no lambda); ``get`` is null-safe out of range.
    """
    idx = F.array_position(column_values["column"]["title"], F.lit(title))
    return F.when(idx > 0, F.get(column_values, (idx - 1).cast("int"))[attr]).otherwise(F.get(column_values, pos)[attr])


def explode_items(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per board item of every page (first board of each page)."""
    keep = keep or []
    items = F.get(F.col("data.boards"), 0)["items_page"]["items"]
    return posexplode_rows(pages, items, keep, "item_pos", "item")


def flatten_cards(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Card rows: title, url, pubDate, description, content_tags; rows without URL dropped."""
    keep = keep or []
    items = explode_items(pages, keep)
    cv = F.col("item.column_values")
    fields = items.select(
        *keep, "item_pos", F.col("item.name").alias("title"), *[_field(cv, t, p, a).alias(n) for n, t, p, a in CARD_FIELDS]
    )
    out = fields.select(
        *keep,
        "item_pos",
        "title",
        # these patterns cannot match an empty string: '' means "no match"
        X.nullif_empty(F.regexp_extract("link", URL_PATTERN, 1)).alias("url"),
        X.nullif_empty(F.regexp_extract("date", DATE_PATTERN, 1)).try_cast("date").alias("pubDate"),
        X.nullif_empty(F.regexp_extract("brief", TEXT_PATTERN, 1)).alias("description"),
        F.coalesce(F.col("tags"), F.lit("")).alias("content_tags"),
    )
    return out.where(F.col("url").isNotNull())


def card_tags(cards: DataFrame, ref_tags: DataFrame, order: list[str]) -> DataFrame:
    """Split card tags, strip, attach guid, keep first per (title, guid).

    A small reference is broadcast: dealt by tag, the rows of a few tags would
    gather in as many tasks and be sorted there by ``keep_first``.
    """
    split = cards.select(*order, "title", F.posexplode(F.split("content_tags", ",")).alias("tag_pos", "tag"))
    tags = split.where(F.col("tag").isNotNull() & (F.col("tag") != "")).withColumn("tag", X.strip("tag"))
    ref = broadcast_if_small(ref_tags.select(F.col("tag").alias("_rtag"), "guid").distinct())
    joined = tags.join(ref, tags["tag"] == ref["_rtag"], "left").select(
        *order, "tag_pos", "title", "tag", F.col("guid").alias("tag_guid")
    )
    first = keep_first(joined, ["title", "tag_guid"], ["tag_pos", *order, "tag"])
    return first.select("title", "tag", "tag_guid")
