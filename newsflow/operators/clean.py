"""Article cleaning: the formatting stage between tagging and loading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions import text as X
from newsflow.operators.dedup import keep_first
from newsflow.schemas import ALL_CATEGORY_COLUMNS

# Field limits of the content table.
TITLE_MAX = 498
DESCRIPTION_MAX = 4998
CREATORS_MAX = 998
FILE_TITLE_MAX = 125
FILE_TITLE_MAX_MANUAL = 150
# Sources kept out of the newsroom view.
NEWSROOM_EXCLUDED = ["Rigzone", "Oil Price.com", "Al Jazeera"]
DEFAULT_REQUEST_PREFIX = "https://requests.example.org/play?art="

CLEAN_COLUMNS = [
    "title",
    "pubDate",
    "url",
    "url_full_txt",
    "creators",
    "description",
    "source",
    *[c for c in ALL_CATEGORY_COLUMNS if c != "current_issues"],
    "tag_concat",
    "tag_score",
]


def with_file_title(df: DataFrame, max_len: int = FILE_TITLE_MAX) -> DataFrame:
    return df.withColumn("file_title", X.file_title("title", max_len))


def stored_title(title: str) -> Column:
    """A raw title as the content table stores it."""
    return X.strip(X.truncate(title, TITLE_MAX))


def apply_field_limits(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "title": stored_title("title"),
            "description": X.truncate("description", DESCRIPTION_MAX),
            "creators": X.truncate("creators", CREATORS_MAX),
        }
    )


def clean_articles(
    tagged: DataFrame,
    order: list[str] | None = None,
    request_prefix: str = DEFAULT_REQUEST_PREFIX,
    excluded_sources: list[str] | None = None,
    keep: list[str] | None = None,
    dedup: bool = True,
) -> DataFrame:
    """Title filter, file title, title dedup, description trim, limits, request URL, newsroom flag.

    With ``dedup=False`` the raw title is kept in ``_raw_title`` so the caller
    can deduplicate later (the dedup commutes with the row-wise steps).

    ``order`` decides which copy of a duplicated title survives (ingestion order
    in production: source rank then sequence).  Steps run in the reference's
    order: the file title is cut from the raw title, dedup precedes the title
    cut, the description is trimmed of a leading title copy before it is cut.
    """
    df = tagged.select(*(keep or []), *[c for c in CLEAN_COLUMNS if c in tagged.columns])
    for c in CLEAN_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    df = df.where(F.col("title").isNotNull())
    df = with_file_title(df)
    if dedup:
        df = keep_first(df, ["title"], order or ["title"])
    else:
        df = df.withColumn("_raw_title", F.col("title"))
    df = df.withColumn("description", X.trim_description("title", "description"))
    df = apply_field_limits(df)
    return df.withColumns(
        {
            "url_request": X.request_url(request_prefix, "file_title"),
            "newsroom": X.newsroom_flag("source", excluded_sources or NEWSROOM_EXCLUDED),
        }
    )
