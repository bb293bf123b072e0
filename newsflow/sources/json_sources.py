"""Flatteners for nested JSON payloads → the article schema (normalisers N14–N16, N19)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.functions import text as X
from newsflow.functions.dates import date_from_parts, feed_date
from newsflow.operators.dedup import keep_first
from newsflow.operators.partitioning import posexplode_rows

DOI_URL = "http://dx.doi.org/"
GUARDIAN_SOURCE = "The Guardian"
SCOPUS_SOURCE = "Elsevier Journals"


def explode_records(payloads: DataFrame, order: list[str]) -> DataFrame:
    """One row per element of ``records``; ``rec_pos`` keeps the element order."""
    return posexplode_rows(payloads, F.col("records"), order, "rec_pos", "r").select(*order, "rec_pos", "r.*")


def springer_articles(records: DataFrame, order: list[str], keep_null_keys: bool = False) -> DataFrame:
    """Records → articles: dedup on doi (first wins), doi URL, ASCII-only abstract."""
    cols = ["language", "title", "creators", "publicationName", "doi", "publisher", "publicationDate", "abstract"]
    firsts = keep_first(records.select(*order, *cols), ["doi"], order, keep_null_keys=keep_null_keys)
    return firsts.select(
        F.col("publisher").alias("source"),
        F.concat(F.lit(DOI_URL), F.col("doi")).alias("url"),
        "title",
        F.array_join(F.col("creators")["creator"], "; ").alias("creators"),
        "doi",
        F.col("publicationName").alias("pubName"),
        F.col("publicationDate").try_cast("date").alias("pubDate"),
        X.ascii_only("abstract").alias("description"),
    )


def guardian_articles(items: DataFrame, body_len: int = 500) -> DataFrame:
    """Guardian items → articles: URL goes to url_full_txt, body cut to ``body_len``."""
    return items.select(
        F.col("webTitle").alias("title"),
        F.col("webUrl").alias("url_full_txt"),
        feed_date("webPublicationDate").alias("pubDate"),
        F.substring(F.col("fields.bodyText"), 1, body_len).alias("description"),
        F.lit(GUARDIAN_SOURCE).alias("source"),
    )


def scopus_articles(items: DataFrame, order: list[str], before: str) -> DataFrame:
    """Scopus results → articles: dedup on doi, then cover date < ``before`` (string compare)."""
    firsts = keep_first(items, ["`prism:doi`"], order)
    kept = firsts.where(F.col("`prism:coverDate`") < F.lit(before))
    return kept.select(
        F.lit(SCOPUS_SOURCE).alias("source"),
        F.concat(F.lit(DOI_URL), F.col("`prism:doi`")).alias("url"),
        F.col("`dc:title`").alias("title"),
        F.col("`dc:creator`").alias("creators"),
        F.col("`prism:doi`").alias("doi"),
        F.col("`prism:publicationName`").alias("pubName"),
        F.col("`prism:coverDate`").try_cast("date").alias("pubDate"),
        F.col("`dc:title`").alias("description"),
    )


def crossref_dates(works: DataFrame) -> DataFrame:
    """CrossRef works → (title, url, pubDate) with the date built from ``date-parts``."""
    return works.select(
        F.get(F.col("title"), 0).alias("title"),
        F.col("URL").alias("url"),
        date_from_parts(F.col("published.`date-parts`")).alias("pubDate"),
    )
