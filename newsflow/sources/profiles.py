"""Per-source normalisers as data: one ``SourceProfile`` record per feed family.

``normalise(items, profile)`` maps feed items (RSS columns: title, link,
author, pubDate/published, updated, summary/description, feed) onto the
article schema with narrow column expressions; the only wide step is the
optional keep-first title dedup.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions import dates as D
from newsflow.functions import text as X
from newsflow.operators.dedup import keep_first


@dataclass(frozen=True)
class SourceProfile:
    name: str
    source: str | None = None
    feed_sources: dict[str, str] = field(default_factory=dict)
    date_rule: str = "feed"  # feed | prefix16 | updated
    text_ops: tuple = ()  # ("before", s) | ("after", s) | ("remove", s) | ("strip",)
    dedup_title: bool = False
    creators: str | None = None  # "author" | "" | None
    title_drop_markers: tuple = ()
    title_after_bar: bool = False
    active: bool = True


# The feed families, their source names and text rules.
LOGO_IMG = '<img src="https://www.capitaliq.spglobal.com/interactivex/images/Platform09/SNL_RSS_logo_small.gif" />'
PROFILES: dict[str, SourceProfile] = {
    p.name: p
    for p in [
        SourceProfile(
            "ee_carbonpulse",
            feed_sources={"eenews": "E&E News", "carbonpulse": "Carbon Pulse", "spglobal": "S&P Global IQ"},
            text_ops=(("before", "</p>"), ("remove", "<p>"), ("remove", LOGO_IMG), ("remove", "S&amp;P ")),
            creators="author",
        ),
        SourceProfile(
            "la_times", "LA Times", text_ops=(("remove", "</p>"), ("remove", "<p>"), ("strip",)), dedup_title=True, creators="author"
        ),
        SourceProfile("mit_smr", "MIT Sloan Management Review"),
        SourceProfile(
            "nyt_newyorker",
            feed_sources={
                "nyt_homepage": "New York Times",
                "nyt_energy": "New York Times",
                "nyt_climate": "New York Times",
                "newyorker_news": "The New Yorker",
                "newyorker_tech": "The New Yorker",
            },
            creators="author",
        ),
        SourceProfile("ogj", "Oil & Gas Journal", dedup_title=True, active=False),
        SourceProfile("ssir", "Stanford Social Innovation Review", date_rule="updated"),
        SourceProfile(
            "sunday_times",
            "Sunday Times Africa",
            text_ops=(("remove", "</p>"), ("remove", "<p>")),
            dedup_title=True,
            title_drop_markers=("WATCH | ", "LISTEN | ", "RECORDED | ", "PODCAST | ", "LIVE | ", "LIVE STREAM | ", "CARTOON |"),
            title_after_bar=True,
        ),
        SourceProfile("washington_post", "Washington Post", date_rule="prefix16", dedup_title=True, creators="author"),
        SourceProfile("wsj", "Wall St. Journal", dedup_title=True, creators=""),
        SourceProfile("al_jazeera", "Al Jazeera", date_rule="prefix16", dedup_title=True),
        SourceProfile("oilprice", "Oil Price.com", date_rule="prefix16", dedup_title=True),
        SourceProfile("rigzone", "Rigzone", date_rule="prefix16", dedup_title=True),
        SourceProfile("times_of_india", "Times of India", text_ops=(("after", "/></a>"),)),
    ]
}


def _text(col: Column, ops: tuple) -> Column:
    for op in ops:
        kind = op[0]
        if kind == "before":
            col = X.before_first(col, op[1])
        elif kind == "after":
            col = X.after_first(col, op[1])
        elif kind == "remove":
            col = F.replace(col, F.lit(op[1]), F.lit(""))
        elif kind == "strip":
            col = X.strip(col)
        else:
            raise ValueError(f"unknown text op {kind}")
    return col


def _date(items: DataFrame, rule: str) -> Column:
    if rule == "feed":
        return D.feed_date("published")
    if rule == "prefix16":
        return D.feed_date_prefix("published", 16)
    if rule == "updated":
        return D.feed_date("updated")
    raise ValueError(f"unknown date rule {rule}")


def _source(profile: SourceProfile) -> Column:
    if profile.feed_sources:
        m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in profile.feed_sources.items()))
        return F.coalesce(m[F.col("feed")], F.col("feed"))
    return F.lit(profile.source)


def normalise(items: DataFrame, profile: SourceProfile, order: list[str] | None = None) -> DataFrame:
    """Feed items → (title, url, pubDate, description, creators, source).

    ``order`` is the ingestion order that decides which duplicate title
    survives; it defaults to a scan-order id.
    """
    df = items
    if profile.title_drop_markers:
        df = df.where(~X.contains_any("title", list(profile.title_drop_markers)))
    title = X.piece_after_bar("title") if profile.title_after_bar else F.col("title")
    creators = {
        "author": F.col("author"),
        "": F.lit(""),
        None: F.lit(None).cast("string"),
    }[profile.creators]
    out = df.select(
        *(order or []),
        title.alias("title"),
        F.col("link").alias("url"),
        _date(df, profile.date_rule).alias("pubDate"),
        _text(F.col("summary"), profile.text_ops).alias("description"),
        creators.alias("creators"),
        _source(profile).alias("source"),
    )
    if profile.dedup_title:
        if not order:
            out = out.withColumn("_seq", F.monotonically_increasing_id())
            order = ["_seq"]
        out = keep_first(out, ["title"], order)
    return out.select("title", "url", "pubDate", "description", "creators", "source")


def rss_items(raw: DataFrame) -> DataFrame:
    """Columns of the XML reader → the item columns ``normalise`` expects.

    The author falls back to ``dc:creator``, the update date to ``dc:date`` and
    then ``pubDate``; the feed key is the landed file's name without extension.
    ``feed_file`` and ``item_seq`` give the order of items where the reader has it.
    """
    where = [F.col("feed").alias("feed_file"), F.col("item_seq")] if "item_seq" in raw.columns else []
    updated = F.coalesce(F.col("updated"), *([F.col("`dc:date`")] if "dc:date" in raw.columns else []), F.col("pubDate"))
    author = F.coalesce(F.col("author"), F.col("`dc:creator`")) if "dc:creator" in raw.columns else F.col("author")
    return raw.select(
        *where,
        "title",
        "link",
        author.alias("author"),
        F.col("pubDate").alias("published"),
        updated.alias("updated"),
        F.col("description").alias("summary"),
        F.regexp_extract(F.col("feed"), r"([^/]+?)(\.[A-Za-z]+)?$", 1).alias("feed"),
    )
