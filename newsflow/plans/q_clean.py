"""Named queries for cleaning, file titles, request URLs and dedup (step 2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsflow.functions import text as X
from newsflow.operators.clean import (
    DEFAULT_REQUEST_PREFIX,
    NEWSROOM_EXCLUDED,
    apply_field_limits,
    clean_articles,
)
from newsflow.operators.dedup import keep_first
from newsflow.operators.tagging import with_description_fallback
from newsflow.plans import fixtures as fx
from newsflow.plans import sql_text as S
from newsflow.plans.fixtures import ARTICLES_SQL
from newsflow.plans.q_tagging import tagged_articles
from newsflow.plans.registry import query
from newsflow.plans.sql_tagging import TAGGED_CTES
from newsflow.schemas import CATEGORY_COLUMNS

FALLBACK = f"WITH {ARTICLES_SQL}, arts AS (SELECT * REPLACE (coalesce(description, title) AS description) FROM articles)"


@query(
    "clean_description",
    f"""{FALLBACK}
SELECT id, title, {S.clean_description('title', 'description')} AS description_clean,
       {S.trim_description('title', 'description')} AS description_trim
FROM arts""",
)
def q_clean_description(spark, sf_dir):
    a = with_description_fallback(fx.articles(spark, sf_dir))
    return a.select(
        "id",
        "title",
        X.clean_description("title", "description").alias("description_clean"),
        X.trim_description("title", "description").alias("description_trim"),
    )


@query(
    "file_title",
    f"""WITH {ARTICLES_SQL}
SELECT id, title, {S.file_title('title', 125)} AS file_title, {S.file_title('title', 150)} AS file_title_manual
FROM articles WHERE title IS NOT NULL""",
)
def q_file_title(spark, sf_dir):
    a = fx.articles(spark, sf_dir).where(F.col("title").isNotNull())
    return a.select("id", "title", X.file_title("title", 125).alias("file_title"), X.file_title("title", 150).alias("file_title_manual"))


@query(
    "file_title_dropped_last",
    f"""WITH {ARTICLES_SQL}
SELECT id, {S.file_title_retitle('title', 150)} AS file_title, {S.drop_last_char('title')} AS title_dropped_last
FROM articles""",
)
def q_file_title_dropped_last(spark, sf_dir):
    a = fx.articles(spark, sf_dir)
    return a.select("id", X.file_title_retitle("title", 150).alias("file_title"), X.drop_last_char("title").alias("title_dropped_last"))


@query(
    "request_url",
    f"""WITH {ARTICLES_SQL}
SELECT id, {S.file_title('title')} AS file_title,
       concat({S.q(DEFAULT_REQUEST_PREFIX)}, {S.quote_plus(S.file_title('title'))}) AS url_request,
       concat({S.q(DEFAULT_REQUEST_PREFIX)}, {S.file_title('title', 150)}) AS url_request_manual
FROM articles""",
)
def q_request_url(spark, sf_dir):
    a = fx.articles(spark, sf_dir)
    ft = X.file_title("title")
    return a.select(
        "id",
        ft.alias("file_title"),
        X.request_url(DEFAULT_REQUEST_PREFIX, ft).alias("url_request"),
        X.request_url(DEFAULT_REQUEST_PREFIX, X.file_title("title", 150), encode=False).alias("url_request_manual"),
    )


@query(
    "newsroom_flag",
    f"""WITH {ARTICLES_SQL}
SELECT id, source, CASE WHEN {S.in_list('source', fx.EXCLUDED_SOURCES)} THEN 0 ELSE 1 END AS newsroom,
       CASE WHEN {S.in_list('source', NEWSROOM_EXCLUDED)} THEN 0 ELSE 1 END AS newsroom_default
FROM articles""",
)
def q_newsroom_flag(spark, sf_dir):
    a = fx.articles(spark, sf_dir)
    return a.select(
        "id",
        "source",
        X.newsroom_flag("source", fx.EXCLUDED_SOURCES).alias("newsroom"),
        X.newsroom_flag("source", NEWSROOM_EXCLUDED).alias("newsroom_default"),
    )


@query(
    "field_limits",
    f"""WITH {ARTICLES_SQL}
SELECT id, {S.strip('substring(title, 1, 498)')} AS title, substring(description, 1, 4998) AS description,
       substring(creators, 1, 998) AS creators
FROM articles""",
)
def q_field_limits(spark, sf_dir):
    a = fx.articles(spark, sf_dir).select("id", "title", "description", "creators")
    return apply_field_limits(a)


@query(
    "dedup_title",
    f"""WITH {ARTICLES_SQL}
SELECT id, title, source FROM (
  SELECT *, row_number() OVER (PARTITION BY title ORDER BY id) AS rn FROM articles) WHERE rn = 1""",
)
def q_dedup_title(spark, sf_dir):
    return keep_first(fx.articles(spark, sf_dir).select("id", "title", "source"), ["title"], ["id"])


_DOI_SQL = """dois AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE concat('10.', CAST(o_custkey AS VARCHAR)) END AS doi,
         o_totalprice
  FROM orders)"""


def _dois(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("10."), F.col("o_custkey").cast("string")))
        .alias("doi"),
        "o_totalprice",
    )


@query(
    "dedup_key_nulls",
    f"""WITH {_DOI_SQL}
SELECT o_orderkey, doi, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY doi ORDER BY o_orderkey) AS rn FROM dois) WHERE rn = 1""",
)
def q_dedup_key_nulls(spark, sf_dir):
    return keep_first(_dois(spark, sf_dir), ["doi"], ["o_orderkey"])


@query(
    "dedup_keep_null_keys",
    f"""WITH {_DOI_SQL}
SELECT o_orderkey, doi, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY doi ORDER BY o_orderkey) AS rn FROM dois) WHERE rn = 1 AND doi IS NOT NULL
UNION ALL SELECT o_orderkey, doi, o_totalprice FROM dois WHERE doi IS NULL""",
)
def q_dedup_keep_null_keys(spark, sf_dir):
    return keep_first(_dois(spark, sf_dir), ["doi"], ["o_orderkey"], keep_null_keys=True)


_CLEAN_SELECT = ", ".join(CATEGORY_COLUMNS)


@query(
    "clean_articles",
    f"""WITH {TAGGED_CTES},
deduped AS (
  SELECT * FROM (
    SELECT *, {S.file_title('title')} AS file_title,
           row_number() OVER (PARTITION BY title ORDER BY id) AS rn
    FROM tagged WHERE title IS NOT NULL) WHERE rn = 1)
SELECT id, {S.strip('substring(title, 1, 498)')} AS title, pubDate, url, creators,
       substring({S.trim_description('title', 'description')}, 1, 4998) AS description,
       source, {_CLEAN_SELECT}, tag_concat, tag_score, file_title,
       concat({S.q(DEFAULT_REQUEST_PREFIX)}, {S.quote_plus('file_title')}) AS url_request,
       CASE WHEN {S.in_list('source', fx.EXCLUDED_SOURCES)} THEN 0 ELSE 1 END AS newsroom
FROM deduped""",
)
def q_clean_articles(spark, sf_dir):
    out = clean_articles(tagged_articles(spark, sf_dir), order=["id"], keep=["id"], excluded_sources=fx.EXCLUDED_SOURCES)
    return out.select(
        "id", "title", "pubDate", "url", "creators", "description", "source", *CATEGORY_COLUMNS,
        "tag_concat", "tag_score", "file_title", "url_request", "newsroom",
    )
