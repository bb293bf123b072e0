"""Named query for the end-to-end daily compile (stages 3–7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsflow.operators.clean import DEFAULT_REQUEST_PREFIX
from newsflow.plans import fixtures as fx
from newsflow.plans import sql_text as S
from newsflow.plans.daily import compile_new_articles
from newsflow.plans.fixtures import ARTICLES_SQL, REF_TAGS_SQL
from newsflow.plans.registry import query
from newsflow.plans.sql_tagging import tagger_ctes
from newsflow.schemas import CATEGORY_COLUMNS

_OUT = ["title", "source", "description", *CATEGORY_COLUMNS, "tag_concat", "tag_score", "file_title", "url_request", "newsroom"]


def daily_incoming(spark, sf_dir):
    a = fx.articles(spark, sf_dir)
    docs = a.where(F.col("id") % 2 == 1).select(
        F.lit(0).alias("src_rank"), F.col("id").alias("src_id"), "title", "description", "creators",
        F.lit("documents").alias("source"), "url", "pubDate",
    )
    conv = fx.table(spark, sf_dir, "conversations").select(
        F.lit(1).alias("src_rank"), (F.col("conv_id") * 1000 + F.col("turn")).alias("src_id"),
        F.concat(F.lit("conversation "), F.col("conv_id").cast("string"), F.lit(" turn "), F.col("turn").cast("string")).alias("title"),
        F.col("text").alias("description"), F.col("role").alias("creators"), F.lit("conversations").alias("source"),
    )
    bench = fx.table(spark, sf_dir, "benchmark").select(
        F.lit(2).alias("src_rank"), F.col("item_id").alias("src_id"), F.substring("text", 1, 80).alias("title"),
        F.col("text").alias("description"), F.lit("benchmark").alias("source"),
        F.concat(F.lit("https://bench.example.org/"), F.col("item_id").cast("string")).alias("url"),
    )
    incoming = docs.unionByName(conv, allowMissingColumns=True).unionByName(bench, allowMissingColumns=True)
    return incoming, a.where(F.col("id") % 2 == 0).select("title")


@query(
    "daily_compile",
    f"""WITH {ARTICLES_SQL}, {REF_TAGS_SQL},
incoming AS (
  SELECT 0 AS src_rank, id AS src_id, title, description, creators, 'documents' AS source, url, pubDate
  FROM articles WHERE id % 2 = 1
  UNION ALL
  SELECT 1, conv_id * 1000 + turn, 'conversation ' || CAST(conv_id AS VARCHAR) || ' turn ' || CAST(turn AS VARCHAR),
         text, role, 'conversations', NULL, NULL FROM conversations
  UNION ALL
  SELECT 2, item_id, substring(text, 1, 80), text, NULL, 'benchmark', 'https://bench.example.org/' || CAST(item_id AS VARCHAR), NULL
  FROM benchmark),
incoming_ids AS (SELECT src_rank * 1000000000000 + src_id AS id, * FROM incoming),
content AS (SELECT title FROM articles WHERE id % 2 = 0),
{tagger_ctes('d_', 'incoming_ids', 'ref_tags')},
deduped AS (
  SELECT * FROM (
    SELECT *, {S.file_title('title')} AS file_title,
           row_number() OVER (PARTITION BY title ORDER BY src_rank, src_id) AS rn
    FROM d_tagged WHERE title IS NOT NULL) WHERE rn = 1),
cleaned AS (
  SELECT {S.strip('substring(title, 1, 498)')} AS title, source,
         substring({S.trim_description('title', 'description')}, 1, 4998) AS description,
         {", ".join(CATEGORY_COLUMNS)}, tag_concat, tag_score, file_title,
         {S.q(DEFAULT_REQUEST_PREFIX)} || {S.quote_plus('file_title')} AS url_request,
         CASE WHEN {S.in_list('source', ['Rigzone', 'Oil Price.com', 'Al Jazeera'])} THEN 0 ELSE 1 END AS newsroom
  FROM deduped)
SELECT {", ".join(_OUT)} FROM cleaned c
WHERE NOT EXISTS (SELECT 1 FROM content x WHERE lower(x.title) = lower(c.title))""",
)
def q_daily_compile(spark, sf_dir):
    incoming, content = daily_incoming(spark, sf_dir)
    incoming = incoming.withColumn("id", F.col("src_rank") * 1_000_000_000_000 + F.col("src_id"))
    out = compile_new_articles(incoming, content, fx.ref_tags(spark), order=["src_rank", "src_id"], keep=["src_rank", "src_id"])
    return out.select(*_OUT)
