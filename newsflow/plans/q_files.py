"""Named queries that go through files: they land feeds and exports as the sources deliver them, run the jobs, and
read back what these wrote.  Files go to a new folder below the shared ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from newsflow.functions import text as X
from newsflow.operators.deals import DEAL_COLUMNS
from newsflow.operators.tagging import tag_articles
from newsflow.plans import fixtures as fx
from newsflow.plans import jobs
from newsflow.plans import sql_text as S
from newsflow.plans.daily import assign_ids, compile_new_articles, run_daily
from newsflow.plans.q_daily import _OUT, daily_incoming
from newsflow.plans.q_deals import PARSED_SQL, deals_raw
from newsflow.plans.q_feeds import _rss_fixture_sql, rss_fixture
from newsflow.plans.registry import ORACLE, query
from newsflow.schemas import DEALS_RAW, DEALS_RENAME
from newsflow.session import checkpoint_dir
from newsflow.sources import html as H


def _scratch(spark) -> str:
    return f"{checkpoint_dir(spark)}/landing-{uuid.uuid4().hex}"


def _xml(c):
    return X.replace_all(c, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")])


def _land(rows, columns, path, root, row):
    """XML files whose items are in the order of doc_id by file name and place."""
    ordered = rows.repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id")
    ordered.select(*columns).write.format("xml").option("rootTag", root).option("rowTag", row).option("validateName", False).save(path)


_FEED_OUT = "title, url, pubDate, description, creators, source"


@query(
    "feed_files_extract",
    f"""WITH {_rss_fixture_sql(["a"])},
i AS (SELECT doc_id, {S.strip('title')} AS title, link, author, {S.strip('summary')} AS summary,
             CAST(DATE '2024-01-01' + CAST(doc_id % 180 AS INTEGER) AS DATE) AS day, published <> 'not a date' AS dated FROM items),
u AS (
  SELECT title, link AS url, CASE WHEN dated THEN day END AS pubDate, {S.strip("replace(replace(summary, '</p>', ''), '<p>', '')")} AS description,
         author AS creators, 'LA Times' AS source
  FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY doc_id) AS rn FROM i WHERE doc_id % 3 = 0) WHERE rn = 1
  UNION ALL
  SELECT title, link, day, summary, NULL, 'Stanford Social Innovation Review' FROM i WHERE doc_id % 3 = 1
  UNION ALL
  SELECT title, link, day, summary, '', 'Wall St. Journal'
  FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY doc_id) AS rn FROM i WHERE doc_id % 3 = 2) WHERE rn = 1)
SELECT {_FEED_OUT} FROM u""",
)
def q_feed_files_extract(spark, sf_dir):
    base = _scratch(spark)
    items = rss_fixture(spark, sf_dir, ["a"])
    item = [F.col(c).alias(c) for c in ("title", "link")] + [F.col("summary").alias("description")]
    atom = [F.col("title"), F.struct(F.col("link").alias("_href"), F.lit("alternate").alias("_rel")).alias("link"), F.col("updated").alias("published"), F.col("summary")]
    rss_root, dc_root = 'rss version="2.0"', 'rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/"'
    third = F.col("doc_id") % 3
    landed = {
        "la_times": (0, [*item, F.col("author"), F.col("published").alias("pubDate")], rss_root, "item"),
        "ssir": (1, [*item, F.col("updated").alias("dc:date")], dc_root, "item"),
        "wsj": (2, atom, 'feed xmlns="http://www.w3.org/2005/Atom"', "entry"),
    }
    for family, (k, columns, root, row) in landed.items():
        _land(items.where(third == k), columns, f"{base}/{family}", root, row)
    out = jobs.extract_feeds(spark, {family: f"{base}/{family}" for family in landed}, f"{base}/extract")
    return out.select(*_FEED_OUT.split(", "))


@query(
    "deal_files_load",
    f"""WITH {PARSED_SQL}
SELECT {", ".join(DEAL_COLUMNS)} FROM parsed p
WHERE o_orderkey % 4 = 0 OR NOT EXISTS (
  SELECT 1 FROM parsed e WHERE e.o_orderkey % 4 = 0 AND e.company IS NOT DISTINCT FROM p.company
    AND e.pubDate IS NOT DISTINCT FROM p.pubDate AND e.deal_size IS NOT DISTINCT FROM p.deal_size)""",
)
def q_deal_files_load(spark, sf_dir):
    base = _scratch(spark)
    raw = deals_raw(spark, sf_dir).withColumnsRenamed({v: k for k, v in DEALS_RENAME.items()})
    for day, part in (("day1", raw.where(F.col("o_orderkey") % 4 == 0)), ("day2", raw)):
        part.select(*[F.col(f"`{c}`") for c in DEALS_RAW.names]).write.csv(f"{base}/{day}/AxiosPro-{day}.csv", header=True)
    for day in ("day1", "day2", "day2"):  # the last run finds nothing new
        jobs.load_deals(spark, f"{base}/{day}", f"{base}/deals")
    return spark.read.parquet(f"{base}/deals")


# ---------------------------------------------------------------- the daily job's tables (K2, K5)


@query("daily_job_tables", ORACLE["daily_compile"])
def q_daily_job_tables(spark, sf_dir):
    """What two runs of the job over the same union leave in the content table beyond what was there."""
    base = _scratch(spark)
    incoming, _ = daily_incoming(spark, sf_dir)
    order = ["src_rank", "src_id"]
    even = tag_articles(fx.articles(spark, sf_dir).where(F.col("id") % 2 == 0), fx.ref_tags(spark))
    shape = assign_ids(compile_new_articles(incoming, even, fx.ref_tags(spark), order), even).schema
    stored = even.select(*[(F.col(f.name) if f.name in even.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in shape])
    stored.write.parquet(f"{base}/content")
    tags = "content_id bigint, tag_cat string, tag string, tag_guid string, cost_center string"
    spark.createDataFrame([], tags).write.parquet(f"{base}/tags")
    for _ in range(2):
        run_daily(incoming, f"{base}/content", f"{base}/tags", f"{base}/staging", fx.ref_tags(spark), fx.profiles(spark), order, fx.EXCLUDED_PROGRAMMES)
    before = stored.agg(F.max("id")).scalar()
    return spark.read.parquet(f"{base}/content").where(F.col("id") > before).select(*_OUT)


# ---------------------------------------------------------------- result cards

CARDS_AS_OF = "2024-03-05 01:00:00"
_LINE = "string_split(text, chr(10))[1]"


@query(
    "result_cards",
    f"""WITH c AS (
  SELECT doc_id, {_LINE} AS t, text, lang, CAST(doc_id % 40 AS INTEGER) AS n FROM documents),
r AS (SELECT doc_id, 'News ' || t || ' & more' AS title, 'https://news.example.org/r/' || CAST(doc_id AS VARCHAR) AS url,
             CAST(TIMESTAMP '{CARDS_AS_OF}' - n * INTERVAL 1 HOUR AS DATE) AS pubDate, 'Seen: ' || text AS description, 'src ' || coalesce(lang, '') AS source FROM c)
SELECT title, url, pubDate, description, source
FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY doc_id) AS rn FROM r) WHERE rn = 1""",
)
def q_result_cards(spark, sf_dir):
    """Two documents a page; titles and snippets hold inner tags, deep nesting and entities."""
    doc = F.col("doc_id")
    line = F.get(F.split("text", "\n"), 0)
    card = F.concat(
        F.lit('<div class="SoaBEf"><div><div><a href="https://news.example.org/r/'), doc.cast("string"), F.lit('"><div class="x MBeuO"><div><span>News</span> '), _xml(line),
        F.lit(' <em>&amp;</em> more</div></div><div class="GI74Re">Seen: <div><div><div>'), _xml(F.col("text")), F.lit('</div></div></div></div><div class="LfVVr"><span>'),
        (doc % 40).cast("string"), F.lit(' hours ago</span></div><div class="NUnG9d"><span>src '), F.coalesce("lang", F.lit("")), F.lit("</span></div></a></div></div></div>"),
    )
    docs = fx.table(spark, sf_dir, "documents", spread=True).select("doc_id", F.floor(doc / 2).alias("page_id"), card.alias("card"))
    cards = docs.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("doc_id", "card"))).alias("c"))  # at most two a page
    html = F.concat(F.lit("<html><body>"), F.array_join(F.transform("c", lambda x: x["card"]), ""), F.lit("</body></html>"))
    return H.result_cards(cards.select("page_id", html.alias("html")), CARDS_AS_OF)


@query(
    "article_cards",
    f"""SELECT CAST(floor(doc_id / 2) AS BIGINT) AS page_id, CAST(doc_id % 2 AS INTEGER) AS card_pos,
  {S.strip(f"'No. ' || {_LINE}")} AS title, CASE WHEN doc_id % 5 <> 0 THEN {S.strip("text")} END AS description FROM documents""",
)
def q_article_cards(spark, sf_dir):
    """Two documents a page, every fifth card without an excerpt; the page has a title outside any card."""
    doc = F.col("doc_id")
    excerpt = F.when(doc % 5 != 0, F.concat(F.lit('<p class="article-card__excerpt">'), _xml(F.col("text")), F.lit("\n</p>"))).otherwise("")
    card = F.concat(F.lit('<article class="big card_gallery"><div><h3 class=\'article-card__title\'> <b>No.</b> '), _xml(F.get(F.split("text", "\n"), 0)), F.lit("</h3>"), excerpt, F.lit("</div></article>"))
    docs = fx.table(spark, sf_dir, "documents", spread=True).select("doc_id", F.floor(doc / 2).alias("page_id"), card.alias("card"))
    cards = docs.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("doc_id", "card"))).alias("c"))  # at most two a page
    html = F.concat(F.lit('<html><h3 class="article-card__title">All</h3>'), F.array_join(F.transform("c", lambda x: x["card"]), "<hr>"), F.lit("</html>"))
    return H.article_cards(cards.select("page_id", html.alias("html")))


# ---------------------------------------------------------------- teasers by the shipped classes

_TEASER_TITLE = f"""CASE doc_id % 11 WHEN 0 THEN 'FT Crossword ' || {_LINE} WHEN 1 THEN 'Letter: ' || {_LINE} WHEN 2 THEN ' Premium content'
  WHEN 3 THEN ' Premium Content' ELSE {_LINE} END"""


@query(
    "html_teasers_by_class",
    f"""WITH t AS (
  SELECT CAST(floor(doc_id / 4) AS BIGINT) AS page_id, doc_id, {_TEASER_TITLE} AS title,
         CASE WHEN doc_id % 7 = 0 THEN 'A Quiz on ' || {_LINE} ELSE text END AS standfirst FROM documents WHERE doc_id % 9 <> 4),
p AS (SELECT page_id, list(title ORDER BY doc_id) AS h, list(standfirst ORDER BY doc_id) FILTER (WHERE doc_id % 13 <> 5) AS s FROM t GROUP BY page_id),
z AS (SELECT page_id, i AS item_pos, h[i] AS title, s[i] AS description FROM p, range(1, len(h) + 1) AS r(i)),
b AS (SELECT page_id, item_pos, nullif(CASE WHEN title IN (' Premium content', ' Premium Content') THEN '' ELSE title END, '') AS title,
             nullif(description, '') AS description FROM z),
k AS (SELECT * FROM b WHERE title IS NOT NULL AND NOT (contains(title, 'FT Crossword') OR contains(title, 'Quiz')
        OR coalesce(contains(description, 'FT Crossword') OR contains(description, 'Quiz'), false))),
f AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY page_id, item_pos) AS rn FROM k)
SELECT title, description, DATE '{fx.AS_OF}' AS pubDate, 'Financial Times' AS source, 'https://www.ft.com/news-feed' AS url
FROM f WHERE rn = 1 AND NOT contains(title, 'Letter: ')""",
)
def q_html_teasers_by_class(spark, sf_dir):
    """Four documents a page, some inside a live block that goes, some without a standfirst, so that later ones move up."""
    doc = F.col("doc_id")
    line = _xml(F.get(F.split("text", "\n"), 0))
    kind = doc % 11
    title = (F.when(kind == 0, F.concat(F.lit("FT Crossword "), line)).when(kind == 1, F.concat(F.lit("<b>Letter</b>: "), line))
             .when(kind == 2, F.lit(" Premium content")).when(kind == 3, F.lit(" <i>Premium</i> Content")).otherwise(line))
    stand = F.when(doc % 7 == 0, F.concat(F.lit("A <em>Quiz</em> on "), line)).otherwise(_xml(F.col("text")))
    teaser = F.concat(F.lit('<div class="o-teaser"><div class="x o-teaser__heading"><a href="#"><div>'), title, F.lit("</div></a></div>"),
                      F.when(doc % 13 == 5, F.lit("")).otherwise(F.concat(F.lit("<p class='o-teaser__standfirst'><span>"), stand, F.lit("</span></p>"))), F.lit("</div>"))
    live = F.when(doc % 9 == 4, F.concat(F.lit('<div class="o-teaser--live-blog-package"><div>Live</div>'), teaser, F.lit("</div>"))).otherwise(teaser)
    docs = fx.table(spark, sf_dir, "documents", spread=True).select("doc_id", F.floor(doc / 4).alias("page_id"), live.alias("t"))
    pages = docs.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("doc_id", "t"))).alias("c"))  # at most four a page
    html = F.concat(F.lit("<html><br>"), F.array_join(F.transform("c", lambda x: x["t"]), "<hr>"), F.lit("</html>"))
    return H.teasers(pages.select("page_id", html.alias("html")), fx.AS_OF)


# ---------------------------------------------------------------- keyword predicate

KEYWORDS = ["Tionaux", "moron", "query"]


@query(
    "keyword_predicate",
    f"""SELECT doc_id, lang, source FROM documents
WHERE {" OR ".join(f"coalesce(contains(lower({c}), {S.q(k.lower())}), false)" for c in ("text", "source") for k in KEYWORDS)}""",
)
def q_keyword_predicate(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").where(X.matches_keywords(["text", "source"], KEYWORDS)).select("doc_id", "lang", "source")
