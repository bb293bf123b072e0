"""Named queries for maintenance jobs (step 9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsflow.functions import text as X
from newsflow.operators.clean import DEFAULT_REQUEST_PREFIX
from newsflow.operators.maintenance import RETAG_COLUMNS, manual_import, refresh_request_urls, retag, retitle, trim_descriptions
from newsflow.operators.tagging import tag_articles
from newsflow.plans import fixtures as fx
from newsflow.plans import sql_text as S
from newsflow.plans.fixtures import ARTICLES_SQL, REF_TAGS_SQL
from newsflow.plans.q_tagging import tagged_articles
from newsflow.plans.registry import query
from newsflow.plans.sql_tagging import TAGGED_CTES, tagger_ctes

RETAG_SINCE = "2024-03-01"
TRIM_SINCE = "2024-04-01"
URL_SINCE = "2024-05-01"
OLD_REF_MAX_SEQ = 12


def _old_content(spark, sf_dir):
    old_ref = fx.ref_tags(spark).where(F.col("ref_seq") <= OLD_REF_MAX_SEQ)
    return tag_articles(fx.articles(spark, sf_dir), old_ref)


_RETAG_SELECT = ",\n       ".join(
    f"CASE WHEN n.tag_concat IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}" for c in RETAG_COLUMNS
)


@query(
    "retag_all",
    f"""WITH {ARTICLES_SQL}, {REF_TAGS_SQL},
ref_old AS (SELECT * FROM ref_tags WHERE ref_seq <= {OLD_REF_MAX_SEQ}),
{tagger_ctes('o_', 'articles', 'ref_old')},
sel AS (SELECT id, title, source, description FROM o_tagged WHERE tag_score IS NOT NULL AND pubDate > DATE '{RETAG_SINCE}'),
{tagger_ctes('n_', 'sel', 'ref_tags')}
SELECT o.id, {_RETAG_SELECT}
FROM o_tagged o LEFT JOIN n_tagged n ON o.id = n.id""",
)
def q_retag_all(spark, sf_dir):
    out = retag(_old_content(spark, sf_dir), fx.ref_tags(spark), RETAG_SINCE)
    return out.select("id", *RETAG_COLUMNS)


def _content_with_dates(spark, sf_dir):
    t = tagged_articles(spark, sf_dir)
    added = F.timestamp_seconds(F.unix_timestamp(F.col("pubDate").cast("timestamp")) + (F.col("id") % 24) * 3600)
    return t.withColumns(
        {
            "date_added": added,
            "file_title": X.file_title("title"),
            "url_request": F.lit(None).cast("string"),
        }
    )


_DATED = f"""{TAGGED_CTES},
dated AS (
  SELECT *, CAST(pubDate AS TIMESTAMP) + (id % 24) * INTERVAL 1 HOUR AS date_added, {S.file_title('title')} AS file_title
  FROM tagged)"""


@query(
    "trim_maintenance",
    f"""WITH {_DATED}
SELECT id, CASE WHEN tag_concat IS NOT NULL AND date_added > TIMESTAMP '{TRIM_SINCE}'
                THEN {S.trim_description('title', 'description')} ELSE description END AS description
FROM dated""",
)
def q_trim_maintenance(spark, sf_dir):
    return trim_descriptions(_content_with_dates(spark, sf_dir), TRIM_SINCE).select("id", "description")


@query(
    "request_url_refresh",
    f"""WITH {_DATED}
SELECT id, CASE WHEN tag_concat IS NOT NULL AND date_added > TIMESTAMP '{URL_SINCE}'
                THEN {S.q(DEFAULT_REQUEST_PREFIX)} || {S.quote_plus('file_title')} END AS url_request
FROM dated""",
)
def q_request_url_refresh(spark, sf_dir):
    return refresh_request_urls(_content_with_dates(spark, sf_dir), URL_SINCE).select("id", "url_request")


def _manual_sheet(spark, sf_dir):
    a = fx.articles(spark, sf_dir)
    sheet = a.where(F.col("id") % 2 == 1).withColumn(
        "request_email", F.concat(F.lit("user"), (F.col("id") % 7).cast("string"), F.lit("@example.org"))
    )
    content = a.where(F.col("id") % 2 == 0)
    return sheet, content


@query(
    "manual_import",
    f"""WITH {ARTICLES_SQL}, {REF_TAGS_SQL},
sheet AS (
  SELECT *, 'user' || CAST(id % 7 AS VARCHAR) || '@example.org' AS request_email
  FROM articles WHERE id % 2 = 1 AND description IS NOT NULL),
content AS (SELECT title FROM articles WHERE id % 2 = 0),
{tagger_ctes('m_', 'sheet', 'ref_tags')},
prepared AS (
  SELECT *, {S.file_title('title', 150)} AS file_title FROM m_tagged WHERE title IS NOT NULL)
SELECT id, title, tag_concat, tag_score, current_issues, file_title,
       {S.q(DEFAULT_REQUEST_PREFIX)} || file_title AS url_request, request_email
FROM prepared p WHERE NOT EXISTS (SELECT 1 FROM content c WHERE c.title = p.title)""",
)
def q_manual_import(spark, sf_dir):
    sheet, content = _manual_sheet(spark, sf_dir)
    out = manual_import(sheet, content, fx.ref_tags(spark))
    return out.select("id", "title", "tag_concat", "tag_score", "current_issues", "file_title", "url_request", "request_email")


@query("retitle", f"WITH {ARTICLES_SQL} SELECT id, {S.file_title_retitle('title', 150)} AS file_title FROM articles")
def q_retitle(spark, sf_dir):
    return retitle(fx.articles(spark, sf_dir)).select("id", "file_title")
