"""Named queries for unions, incremental loads and maintenance (step 3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsflow.functions import dates as D
from newsflow.operators.load import missing_from_backup, new_rows, range_counts, restore_range, update_by_key
from newsflow.plans import fixtures as fx
from newsflow.plans.fixtures import ARTICLES_SQL
from newsflow.plans.q_tagging import tagged_articles
from newsflow.plans.registry import query
from newsflow.plans.sql_tagging import TAGGED_CTES

BOUNDARY = "1998-01-01"


def _sources(spark, sf_dir):
    docs = fx.articles(spark, sf_dir).select("title", "description", "creators", "source", "url", "pubDate").withColumn(
        "source", F.lit("documents")
    )
    conv = fx.table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("conversation "), F.col("conv_id").cast("string"), F.lit(" turn "), F.col("turn").cast("string")).alias("title"),
        F.col("text").alias("description"),
        F.col("role").alias("creators"),
        F.lit("conversations").alias("source"),
    )
    bench = fx.table(spark, sf_dir, "benchmark").select(
        F.substring("text", 1, 80).alias("title"),
        F.col("text").alias("description"),
        F.lit("benchmark").alias("source"),
        F.concat(F.lit("https://bench.example.org/"), F.col("item_id").cast("string")).alias("url"),
    )
    return docs.unionByName(conv, allowMissingColumns=True).unionByName(bench, allowMissingColumns=True)


@query(
    "union_sources",
    f"""WITH {ARTICLES_SQL}
SELECT title, description, creators, 'documents' AS source, url, pubDate FROM articles
UNION ALL
SELECT concat('conversation ', CAST(conv_id AS VARCHAR), ' turn ', CAST(turn AS VARCHAR)), text, role, 'conversations', NULL, NULL
FROM conversations
UNION ALL
SELECT substring(text, 1, 80), text, NULL, 'benchmark', concat('https://bench.example.org/', CAST(item_id AS VARCHAR)), NULL
FROM benchmark""",
)
def q_union_sources(spark, sf_dir):
    return _sources(spark, sf_dir)


# content = even ids; incoming = odd ids plus upper-cased copies of ids divisible by 8.
# Only ASCII letters are upper-cased: engines disagree on non-ASCII upper case
# (e.g. 'ß' → 'SS' or 'ẞ'), which would test the engines, not the load.
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
_CONTENT_SQL = f"""{ARTICLES_SQL},
content AS (SELECT id, title FROM articles WHERE id % 2 = 0),
incoming AS (
  SELECT id, title, false AS is_copy FROM articles WHERE id % 2 = 1
  UNION ALL SELECT id, translate(title, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), true
  FROM articles WHERE id % 8 = 0)"""


def _content_incoming(spark, sf_dir):
    a = fx.articles(spark, sf_dir).select("id", "title")
    content = a.where(F.col("id") % 2 == 0)
    incoming = a.where(F.col("id") % 2 == 1).withColumn("is_copy", F.lit(False)).unionByName(
        a.where(F.col("id") % 8 == 0).select("id", F.translate("title", _LOWER, _UPPER).alias("title"), F.lit(True).alias("is_copy"))
    )
    return content, incoming


@query(
    "load_new_titles_ci",
    f"""WITH {_CONTENT_SQL}
SELECT i.id, i.title, i.is_copy FROM incoming i
WHERE NOT EXISTS (SELECT 1 FROM content c WHERE lower(c.title) = lower(i.title))""",
)
def q_load_new_titles_ci(spark, sf_dir):
    content, incoming = _content_incoming(spark, sf_dir)
    return new_rows(incoming, content, ["title"], case_insensitive=True)


@query(
    "load_new_titles_cs",
    f"""WITH {_CONTENT_SQL}
SELECT i.id, i.title, i.is_copy FROM incoming i
WHERE NOT EXISTS (SELECT 1 FROM content c WHERE c.title = i.title)""",
)
def q_load_new_titles_cs(spark, sf_dir):
    content, incoming = _content_incoming(spark, sf_dir)
    return new_rows(incoming, content, ["title"])


@query(
    "new_content_ids",
    f"""WITH {TAGGED_CTES},
existing AS (SELECT id AS content_id FROM tagged WHERE tag_concat IS NOT NULL AND id % 3 = 0)
SELECT id FROM tagged t WHERE tag_concat IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM existing e WHERE e.content_id = t.id)""",
)
def q_new_content_ids(spark, sf_dir):
    tagged = tagged_articles(spark, sf_dir).where(F.col("tag_concat").isNotNull()).select("id")
    # untagged ids in the existing set never meet the tagged side: plain article ids suffice
    existing = fx.articles(spark, sf_dir).where(F.col("id") % 3 == 0).select(F.col("id").alias("content_id"))
    return tagged.join(existing, tagged["id"] == existing["content_id"], "left_anti")


_ORDERS_CONTENT_SQL = """content AS (
  SELECT o_orderkey AS id, o_orderstatus AS status, o_orderpriority AS priority, o_orderdate AS request_date,
         CAST(NULL AS VARCHAR) AS url_full_txt
  FROM orders),
staging AS (
  SELECT o_orderkey AS id,
         CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE concat('X', o_orderstatus) END AS status,
         concat('https://files.example.org/', CAST(o_orderkey AS VARCHAR)) AS url_full_txt,
         o_orderdate + INTERVAL 1 DAY AS request_date
  FROM orders WHERE o_orderkey % 5 = 0)"""


def _orders_content(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    content = o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("request_date"),
        F.lit(None).cast("string").alias("url_full_txt"),
    )
    staging = o.where(F.col("o_orderkey") % 5 == 0).select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("X"), F.col("o_orderstatus")))
        .alias("status"),
        F.concat(F.lit("https://files.example.org/"), F.col("o_orderkey").cast("string")).alias("url_full_txt"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("request_date"),
    )
    return content, staging


@query(
    "update_from_staging",
    f"""WITH {_ORDERS_CONTENT_SQL}
SELECT c.id,
       CASE WHEN s.id IS NOT NULL THEN s.status ELSE c.status END AS status,
       c.priority,
       CASE WHEN s.id IS NOT NULL THEN s.request_date ELSE c.request_date END AS request_date,
       CASE WHEN s.id IS NOT NULL THEN s.url_full_txt ELSE c.url_full_txt END AS url_full_txt
FROM content c LEFT JOIN staging s ON c.id = s.id""",
)
def q_update_from_staging(spark, sf_dir):
    content, staging = _orders_content(spark, sf_dir)
    return update_by_key(content, staging, "id", ["status", "request_date", "url_full_txt"])


@query(
    "overwrite_staging",
    """SELECT o_orderkey AS id,
       concat('https://files.example.org/', CAST(o_orderkey AS VARCHAR)) AS url_full_txt,
       CAST(o_orderdate AS TIMESTAMP) AS request_date, o_orderpriority AS requested
FROM orders WHERE o_orderkey % 3 <> 0""",
)
def q_overwrite_staging(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    sheet = o.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("https://files.example.org/"), F.col("o_orderkey").cast("string")))
        .alias("url_full_txt"),
        D.strip_zone("o_orderdate").alias("request_date"),
        F.col("o_orderpriority").alias("requested"),
    )
    return sheet.na.drop(subset=["url_full_txt"])


_RECOVERY_SQL = f"""cur AS (
  SELECT o_orderkey AS id, o_orderdate AS date_added, o_orderstatus AS status FROM orders
  WHERE NOT (o_orderdate < TIMESTAMP '{BOUNDARY}' AND o_orderkey % 3 = 0)),
bak AS (
  SELECT o_orderkey AS id, o_orderdate AS date_added, 'B' AS status FROM orders
  WHERE o_orderdate < TIMESTAMP '{BOUNDARY}' AND o_custkey % 7 <> 0),
restored AS (
  SELECT * FROM cur WHERE NOT (date_added < TIMESTAMP '{BOUNDARY}') OR date_added IS NULL
  UNION ALL SELECT * FROM bak WHERE date_added < TIMESTAMP '{BOUNDARY}')"""


def _recovery(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    b = F.lit(BOUNDARY).cast("timestamp")
    cur = o.where(~((F.col("o_orderdate") < b) & (F.col("o_orderkey") % 3 == 0))).select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("date_added"), F.col("o_orderstatus").alias("status")
    )
    bak = o.where((F.col("o_orderdate") < b) & (F.col("o_custkey") % 7 != 0)).select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("date_added"), F.lit("B").alias("status")
    )
    return cur, bak, b


@query("restore_range", f"WITH {_RECOVERY_SQL} SELECT id, date_added, status FROM restored")
def q_restore_range(spark, sf_dir):
    cur, bak, b = _recovery(spark, sf_dir)
    return restore_range(cur, bak, "date_added", b)


@query(
    "recovery_missing_ids",
    f"""WITH {_RECOVERY_SQL}
SELECT id FROM cur WHERE date_added < TIMESTAMP '{BOUNDARY}' AND id NOT IN (SELECT id FROM bak)""",
)
def q_recovery_missing_ids(spark, sf_dir):
    cur, bak, b = _recovery(spark, sf_dir)
    return missing_from_backup(cur, bak, "id", "date_added", b)


@query(
    "recovery_counts",
    f"""WITH {_RECOVERY_SQL}
SELECT (SELECT count(*) FROM cur WHERE date_added < TIMESTAMP '{BOUNDARY}') AS n_before_range,
       (SELECT count(*) FROM cur) AS n_before_total,
       (SELECT count(*) FROM cur WHERE NOT (date_added < TIMESTAMP '{BOUNDARY}') OR date_added IS NULL) AS n_after_delete,
       (SELECT count(*) FROM restored WHERE date_added < TIMESTAMP '{BOUNDARY}') AS n_after_range,
       (SELECT count(*) FROM restored) AS n_after_total""",
)
def q_recovery_counts(spark, sf_dir):
    cur, bak, b = _recovery(spark, sf_dir)
    return range_counts(cur, restore_range(cur, bak, "date_added", b), "date_added", b)


@query(
    "recovery_flag_counts",
    f"""WITH {_RECOVERY_SQL}
SELECT (id IN (SELECT id FROM bak)) AS in_backup, count(*) AS n
FROM cur WHERE date_added < TIMESTAMP '{BOUNDARY}' GROUP BY 1""",
)
def q_recovery_flag_counts(spark, sf_dir):
    cur, bak, b = _recovery(spark, sf_dir)
    ids = bak.select(F.col("id").alias("bid"), F.lit(True).alias("hit")).distinct()
    old = cur.where(F.col("date_added") < b)
    flagged = old.join(ids, old["id"] == ids["bid"], "left").select(F.coalesce("hit", F.lit(False)).alias("in_backup"))
    return flagged.groupBy("in_backup").agg(F.count("*").alias("n"))
