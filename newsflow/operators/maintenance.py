"""Table maintenance jobs: re-tag, description trim, request-URL refresh,
manual import and re-title – each returns the next snapshot (or the rows to
append) of the content table.

All of them are "select a slice → recompute columns → keyed update": the
slice is a pushed-down predicate on the content scan, the recompute is
narrow, and the keyed update is one left join on ``id`` (AQE broadcasts the
slice when it is small, otherwise a sort-merge join with skew handling).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.functions import text as X
from newsflow.operators.clean import DEFAULT_REQUEST_PREFIX, FILE_TITLE_MAX_MANUAL
from newsflow.operators.load import new_rows, update_by_key
from newsflow.operators.tagging import char_limit, inline_dictionary, tag_articles, tag_columns, with_description_fallback
from newsflow.schemas import ALL_CATEGORY_COLUMNS

RETAG_COLUMNS = [*ALL_CATEGORY_COLUMNS, "tag_concat", "tag_score"]


def retag(content: DataFrame, ref_tags: DataFrame, since: str, columns: list[str] | None = None) -> DataFrame:
    """Re-tag scored content published after ``since`` with the current dictionary.

    One text cap for the whole slice (not per 500-row batch); rows that end
    up with no tag keep their old tags; all tag columns are rewritten by
    default (Q26).  The slice comes from the same snapshot, so the keyed
    update is a conditional projection: no join, no shuffle; the phrase test
    is skipped outside the slice.
    """
    cols = columns or RETAG_COLUMNS
    mask = F.col("tag_score").isNotNull() & (F.col("pubDate") > F.lit(since).cast("date"))
    try:
        by_cat = inline_dictionary(ref_tags)
    except ValueError:
        # dictionary beyond the inline bound: tag the slice with the join-based
        # strategy and apply it as a keyed update by id
        sel = content.where(mask).select("id", "title", "source", "description")
        fresh = tag_articles(sel, ref_tags, strategy="kgram").where(F.col("tag_concat").isNotNull())
        return update_by_key(content, fresh.select("id", *cols), "id", cols)
    cap = char_limit(with_description_fallback(content.where(mask)))
    desc = F.coalesce(F.col("description"), F.col("title"))
    desc_match = F.when(mask, F.lower(F.substring(desc, F.lit(1), cap)))
    fresh = tag_columns(content, desc_match, by_cat, prefix="_n_")
    hit = mask & F.col("_n_tag_concat").isNotNull()
    out = fresh.withColumns({c: F.when(hit, F.col("_n_" + c)).otherwise(F.col(c)) for c in cols})
    return out.select(*content.columns)


def _slice(since: str, column: str):
    return F.col("tag_concat").isNotNull() & (F.col(column) > F.lit(since).cast("timestamp"))


def trim_descriptions(content: DataFrame, since: str, column: str = "date_added") -> DataFrame:
    """Drop a leading title copy (and leading dots/blanks) from recent tagged descriptions."""
    new = X.trim_description("title", "description")
    return content.withColumn("description", F.when(_slice(since, column), new).otherwise(F.col("description")))


def refresh_request_urls(
    content: DataFrame, since: str, prefix: str = DEFAULT_REQUEST_PREFIX, column: str = "date_added"
) -> DataFrame:
    new = X.request_url(prefix, "file_title")
    return content.withColumn("url_request", F.when(_slice(since, column), new).otherwise(F.col("url_request")))


def manual_import(sheet: DataFrame, content: DataFrame, ref_tags: DataFrame, prefix: str = DEFAULT_REQUEST_PREFIX) -> DataFrame:
    """Manual submissions → rows to append: tagged with their own cap, un-encoded request URL,
    titles already stored (case-sensitive) removed."""
    subs = sheet.where(F.col("description").isNotNull())
    tagged = tag_articles(subs, ref_tags).where(F.col("title").isNotNull())
    tagged = tagged.withColumn("file_title", X.file_title("title", FILE_TITLE_MAX_MANUAL))
    tagged = tagged.withColumn("url_request", X.request_url(prefix, "file_title", encode=False))
    return new_rows(tagged, content.select("title"), ["title"])


def retitle(content: DataFrame, max_len: int = 150) -> DataFrame:
    """Recompute every file title in place (keyed update, not an append – Q25)."""
    return content.withColumn("file_title", X.file_title_retitle("title", max_len))
