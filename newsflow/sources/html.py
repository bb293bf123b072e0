"""HTML extraction over a ``pages(page_id, url, html)`` table.

Elements are found by class in one pass over a page (``html_tree``).  Patterns
use ``[^<]*`` / ``[^"]*`` classes rather than ``.`` so that Java and RE2 agree on
pages containing line breaks.  Extraction is per page (narrow); positional
pairing happens inside each page with ``arrays_zip`` (Q15).
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions import dates as D
from newsflow.functions import text as X
from newsflow.operators.dedup import keep_first
from newsflow.operators.partitioning import posexplode_rows
from newsflow.sources.html_tree import elements_of

HREF_PATTERN = r'<a[^>]*href="([^"]*)"'
TAG_PATTERN = r"<[^>]+>"
# The HTML entities decoded in extracted text.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]

# Teaser page (class names, filters, constants).
TEASER_HEADING = "o-teaser__heading"
TEASER_STANDFIRST = "o-teaser__standfirst"
TEASER_LIVE_BLOCK = "o-teaser--live-blog-package"
TEASER_EXCLUDE = ["FT Crossword", "Quiz"]
TEASER_TITLE_EXCLUDE = "Letter: "
TEASER_BLANKED_TITLES = [" Premium content", " Premium Content"]
TEASER_SOURCE = "Financial Times"
TEASER_URL = "https://www.ft.com/news-feed"

# Search-result card page classes.
# a card runs from its marker class to the next card's marker (or the page end)
CARD_MARKER = 'class="SoaBEf"'
ARTICLE_CARD = "card_gallery"
ARTICLE_CARD_FIELDS = {"title": "article-card__title", "description": "article-card__excerpt"}
CARD_FIELDS = {"title": "MBeuO", "snippet": "GI74Re", "date": "LfVVr", "source": "NUnG9d"}


def text_of(col: Column) -> Column:
    """``get_text()``: drop tags, decode common entities."""
    out = F.regexp_replace(col, TAG_PATTERN, "")
    return X.replace_all(out, ENTITIES)


def links(pages: DataFrame, relative_only: bool = True) -> DataFrame:
    """(page_id, link_pos, href): every ``<a href>`` of a page, relative ones by default."""
    out = posexplode_rows(pages, F.regexp_extract_all("html", F.lit(HREF_PATTERN), 1), ["page_id"], "link_pos", "href")
    return out.where(F.col("href").startswith("/")) if relative_only else out


def zipped_extract(
    pages: DataFrame, first_pattern: str, second_pattern: str, drop_block: str | None = None
) -> DataFrame:
    """(page_id, item_pos, first, second): the matches of two patterns paired by position per page."""
    html = F.regexp_replace("html", drop_block, "") if drop_block else F.col("html")
    pairs = F.arrays_zip(
        F.regexp_extract_all(html, F.lit(first_pattern), 1).alias("first"),
        F.regexp_extract_all(html, F.lit(second_pattern), 1).alias("second"),
    )
    return _paired(pages, pairs)


def zipped_elements(pages: DataFrame, first_class: str, second_class: str, drop_class: str | None = None) -> DataFrame:
    """(page_id, item_pos, first, second): the elements of two classes paired by position per page."""
    found = elements_of(pages.sparkSession, F.col("html"), [first_class, second_class], drop_class)
    df = pages.select("page_id", found.alias("_e"))
    return _paired(df, F.arrays_zip(F.col("_e.c0").alias("first"), F.col("_e.c1").alias("second")))


def _paired(pages: DataFrame, pairs: Column) -> DataFrame:
    return posexplode_rows(pages, pairs, ["page_id"], "item_pos", "p").select(
        "page_id", "item_pos", text_of(F.col("p.first")).alias("first"), text_of(F.col("p.second")).alias("second")
    )


def teasers(
    pages: DataFrame,
    as_of: str,
    heading: str = TEASER_HEADING,
    standfirst: str = TEASER_STANDFIRST,
    drop_block: str | None = TEASER_LIVE_BLOCK,
    extract: Callable[..., DataFrame] = zipped_elements,
) -> DataFrame:
    """Teaser listing pages → articles (title, description, pubDate, source, url).

    ``heading``, ``standfirst`` and ``drop_block`` are classes, or patterns with ``extract=zipped_extract``.
    """
    z = extract(pages, heading, standfirst, drop_block)
    title = F.col("first")
    for blank in TEASER_BLANKED_TITLES:
        title = F.when(title == F.lit(blank), F.lit("")).otherwise(title)
    df = z.select("page_id", "item_pos", X.nullif_empty(title).alias("title"), X.nullif_empty("second").alias("description"))
    bad = X.contains_any("title", TEASER_EXCLUDE) | X.contains_any("description", TEASER_EXCLUDE)
    df = df.where(F.col("title").isNotNull() & ~bad)
    df = keep_first(df, ["title"], ["page_id", "item_pos"])
    df = df.where(~F.col("title").contains(TEASER_TITLE_EXCLUDE))
    return df.select(
        "title",
        "description",
        F.lit(as_of).cast("date").alias("pubDate"),
        F.lit(TEASER_SOURCE).alias("source"),
        F.lit(TEASER_URL).alias("url"),
    )


def result_cards(pages: DataFrame, as_of: str, marker: str = CARD_MARKER, fields: dict | None = None) -> DataFrame:
    """Search-result pages → one article per card; dates like '2 hours ago' resolved at ``as_of``."""
    blocks = F.split("html", re.escape(marker))
    cards = posexplode_rows(pages, F.slice(blocks, 2, F.size(blocks)), ["page_id"], "card_pos", "card")
    fields = fields or CARD_FIELDS
    found = elements_of(pages.sparkSession, F.col("card"), list(fields.values()))
    cards = cards.select("page_id", "card_pos", X.regexp_extract_or_null(F.col("card"), HREF_PATTERN).alias("link"), found.alias("_e"))
    texts = [text_of(F.get(F.col(f"_e.c{k}"), F.lit(0))).alias(name) for k, name in enumerate(fields)]
    df = cards.select("page_id", "card_pos", "link", *texts).select(
        "page_id",
        "card_pos",
        "title",
        F.col("link").alias("url"),
        D.relative_date(F.col("date"), as_of).alias("pubDate"),
        F.col("snippet").alias("description"),
        "source",
    )
    return keep_first(df, ["title"], ["page_id", "card_pos"]).select("title", "url", "pubDate", "description", "source")


def article_cards(pages: DataFrame, card: str = ARTICLE_CARD, fields: dict | None = None) -> DataFrame:
    """(page_id, card_pos, title, description): the stripped text of the first element of each class in every card."""
    fields = fields or ARTICLE_CARD_FIELDS
    found = pages.select("page_id", elements_of(pages.sparkSession, F.col("html"), [card]).alias("_e"))
    cards = posexplode_rows(found, F.col("_e.c0"), ["page_id"], "card_pos", "card")
    parts = cards.select("page_id", "card_pos", elements_of(pages.sparkSession, F.col("card"), list(fields.values())).alias("_e"))
    texts = [X.strip(text_of(F.get(F.col(f"_e.c{k}"), F.lit(0)))).alias(name) for k, name in enumerate(fields)]
    return parts.select("page_id", "card_pos", *texts)
