"""Named queries for JSON payload sources, cards and landing gaps (step 7).

Payloads are built from the test tables with ``to_json`` and parsed back with
``from_json`` and the production schemas, so the flatteners run on exactly the
nested shapes the file readers produce.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from newsflow import schemas as SC
from newsflow.operators.load import landing_gaps
from newsflow.operators.cards import DATE_PATTERN, TEXT_PATTERN, URL_PATTERN, card_tags, flatten_cards
from newsflow.plans import fixtures as fx
from newsflow.plans import sql_text as S
from newsflow.operators.partitioning import posexplode_rows
from newsflow.plans.registry import ORACLE, query
from newsflow.sources.json_sources import (
    crossref_dates,
    explode_records,
    guardian_articles,
    scopus_articles,
    springer_articles,
)

# Table rows of a task whose payloads are deduplicated: the map-side combine of
# ``keep_first`` sorts the parsed records (some 400 bytes each) of its whole task.
PAYLOAD_ROWS = 100_000

# ---------------------------------------------------------------- records


def _records_payloads(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders", max_rows=PAYLOAD_ROWS)
    key = F.col("o_orderkey").cast("string")
    publisher = F.when(F.col("o_orderstatus") == "F", "Springer").when(F.col("o_orderstatus") == "O", "Nature").otherwise("BMC")
    pub_date = F.date_format("o_orderdate", "yyyy-MM-dd")

    def rec(title, creators, doi, abstract):
        return F.struct(
            F.lit("en").alias("language"),
            title.alias("title"),
            creators.alias("creators"),
            F.concat(F.lit("Journal "), F.col("o_orderpriority")).alias("publicationName"),
            doi.alias("doi"),
            publisher.alias("publisher"),
            pub_date.alias("publicationDate"),
            abstract.alias("abstract"),
        )

    author = F.struct(F.concat(F.lit("Author "), F.col("o_custkey").cast("string")).alias("creator"))
    editor = F.struct(F.concat(F.lit("Editor "), (F.col("o_orderkey") % 13).cast("string")).alias("creator"))
    a = rec(
        F.concat(F.lit("Study "), key), F.array(author), F.concat(F.lit("10.1000/"), key),
        F.concat(F.lit("Résumé "), key, F.lit(" – "), F.col("o_orderpriority")),
    )
    b = rec(
        F.concat(F.lit("Review "), key), F.array(author, editor),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("10.2000/"), (F.col("o_orderkey") % 1000).cast("string"))
        ),
        F.concat(F.lit("Überblick "), key),
    )
    payload = F.to_json(F.struct(F.array(a, b).alias("records")))
    return o.select("o_orderkey", F.from_json(payload, SC.SPRINGER_PAYLOAD).alias("p")).select("o_orderkey", "p.records")


_RECORDS_SQL = """recs AS (
  SELECT o_orderkey, 0 AS rec_pos, concat('Study ', CAST(o_orderkey AS VARCHAR)) AS title,
         concat('Author ', CAST(o_custkey AS VARCHAR)) AS creators,
         concat('10.1000/', CAST(o_orderkey AS VARCHAR)) AS doi,
         concat('Résumé ', CAST(o_orderkey AS VARCHAR), ' – ', o_orderpriority) AS abstract,
         o_orderstatus, o_orderpriority, o_orderdate FROM orders
  UNION ALL
  SELECT o_orderkey, 1, concat('Review ', CAST(o_orderkey AS VARCHAR)),
         concat('Author ', CAST(o_custkey AS VARCHAR), '; Editor ', CAST(o_orderkey % 13 AS VARCHAR)),
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE concat('10.2000/', CAST(o_orderkey % 1000 AS VARCHAR)) END,
         concat('Überblick ', CAST(o_orderkey AS VARCHAR)),
         o_orderstatus, o_orderpriority, o_orderdate FROM orders),
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY o_orderkey, rec_pos) AS rn FROM recs) WHERE rn = 1)"""


@query(
    "json_records",
    f"""WITH {_RECORDS_SQL}
SELECT CASE o_orderstatus WHEN 'F' THEN 'Springer' WHEN 'O' THEN 'Nature' ELSE 'BMC' END AS source,
       'http://dx.doi.org/' || doi AS url, title, creators, doi,
       concat('Journal ', o_orderpriority) AS pubName, CAST(o_orderdate AS DATE) AS pubDate,
       regexp_replace(abstract, '[^\\x00-\\x7F]', '', 'g') AS description
FROM firsts""",
)
def q_json_records(spark, sf_dir):
    recs = explode_records(_records_payloads(spark, sf_dir), ["o_orderkey"])
    return springer_articles(recs, ["o_orderkey", "rec_pos"])


# ---------------------------------------------------------------- guardian (S3)


def _guardian_items(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents", spread=True)
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 180).cast("int")).cast("string")
    item = F.struct(
        F.substring(F.get(F.split("text", "\n"), 0), 1, 120).alias("webTitle"),
        F.concat(day, F.lit("T"), F.lpad((F.col("doc_id") % 24).cast("string"), 2, "0"), F.lit(":30:00Z")).alias("webPublicationDate"),
        F.concat(F.lit("https://www.example.com/world/"), F.col("doc_id").cast("string")).alias("webUrl"),
        F.struct(F.col("text").alias("bodyText")).alias("fields"),
    )
    parsed = d.select(F.from_json(F.to_json(F.array(item)), f"ARRAY<STRUCT<{SC.GUARDIAN_ITEM.replace(' STRING', ':STRING').replace(' STRUCT', ':STRUCT')}>>").alias("a"))
    return posexplode_rows(parsed, F.col("a"), [], "_pos", "i").select("i.*")


@query(
    "guardian_flatten",
    """SELECT substring(string_split(text, chr(10))[1], 1, 120) AS title,
       concat('https://www.example.com/world/', CAST(doc_id AS VARCHAR)) AS url_full_txt,
       CAST(DATE '2024-01-01' + CAST(doc_id % 180 AS INTEGER) AS DATE) AS pubDate,
       substring(text, 1, 500) AS description, 'The Guardian' AS source
FROM documents""",
)
def q_guardian_flatten(spark, sf_dir):
    return guardian_articles(_guardian_items(spark, sf_dir))


# ---------------------------------------------------------------- scopus

SCOPUS_BEFORE = "2000-01-01"


def _scopus_items(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders", max_rows=PAYLOAD_ROWS)
    item = F.struct(
        F.concat(F.lit("Paper "), F.col("o_orderkey").cast("string")).alias("dc:title"),
        F.concat(F.lit("Author "), F.col("o_custkey").cast("string")).alias("dc:creator"),
        F.concat(F.lit("Journal "), F.col("o_orderpriority")).alias("prism:publicationName"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("prism:coverDate"),
        F.lit("Article").alias("subtypeDescription"),
        F.concat(F.lit("10.3000/"), F.col("o_custkey").cast("string")).alias("prism:doi"),
        F.lit("false").alias("openaccessFlag"),
    )
    return o.select("o_orderkey", F.from_json(F.to_json(item), SC.SCOPUS_ITEM).alias("i")).select("o_orderkey", "i.*")


@query(
    "scopus_flatten",
    f"""WITH firsts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1)
SELECT 'Elsevier Journals' AS source, concat('http://dx.doi.org/10.3000/', CAST(o_custkey AS VARCHAR)) AS url,
       concat('Paper ', CAST(o_orderkey AS VARCHAR)) AS title, concat('Author ', CAST(o_custkey AS VARCHAR)) AS creators,
       concat('10.3000/', CAST(o_custkey AS VARCHAR)) AS doi, concat('Journal ', o_orderpriority) AS pubName,
       CAST(o_orderdate AS DATE) AS pubDate, concat('Paper ', CAST(o_orderkey AS VARCHAR)) AS description
FROM firsts WHERE strftime(o_orderdate, '%Y-%m-%d') < '{SCOPUS_BEFORE}'""",
)
def q_scopus_flatten(spark, sf_dir):
    return scopus_articles(_scopus_items(spark, sf_dir), ["o_orderkey"], SCOPUS_BEFORE)


# ---------------------------------------------------------------- crossref


def _crossref_works(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders", spread=True)
    y, m, d = F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")
    parts = F.when(F.col("o_orderkey") % 4 == 0, F.array(F.array(y, m))).otherwise(F.array(F.array(y, m, d)))
    work = F.struct(
        F.array(F.concat(F.lit("Work "), F.col("o_orderkey").cast("string"))).alias("title"),
        F.concat(F.lit("https://doi.example.org/"), F.col("o_orderkey").cast("string")).alias("URL"),
        F.lit(None).cast("string").alias("abstract"),
        F.struct(parts.alias("date-parts")).alias("published"),
    )
    return o.select(F.from_json(F.to_json(work), SC.CROSSREF_ITEM).alias("w")).select("w.*")


@query(
    "crossref_dates",
    """SELECT concat('Work ', CAST(o_orderkey AS VARCHAR)) AS title,
       concat('https://doi.example.org/', CAST(o_orderkey AS VARCHAR)) AS url,
       make_date(year(o_orderdate), month(o_orderdate), CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE day(o_orderdate) END) AS pubDate
FROM orders""",
)
def q_crossref_dates(spark, sf_dir):
    return crossref_dates(_crossref_works(spark, sf_dir))


# ---------------------------------------------------------------- cards


def _card_raw_cols():
    e = F.col
    k = F.get_json_object("props", "$.k").cast("int")
    status = F.concat(F.lit('"'), e("event_type"), F.lit('"'))
    link = F.when(e("event_type") == "error", F.lit('{"text":"none"}')).otherwise(
        F.concat(F.lit('{"url":"https://cards.example.org/e'), e("event_id").cast("string"), F.lit('","text":"Card"}'))
    )
    date = F.concat(
        F.lit('{"date":"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('","changed_at":"'),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('"}'),
    )
    brief = F.concat(
        F.lit('"  '), F.floor("value").cast("bigint").cast("string"), F.lit(" "), e("event_type"),
        F.lit(" card for user "), e("user_id").cast("string"), F.lit('"'),
    )
    tags = (
        F.when(k % 5 == 0, F.lit("Carbon, Solar"))
        .when(k % 5 == 1, F.lit("Water"))
        .when(k % 5 == 2, F.lit(None).cast("string"))
        .when(k % 5 == 3, F.lit(" Methane,,Bonds "))
        .otherwise(F.lit("Unknown Tag, Carbon"))
    )
    return status, link, date, brief, tags


def card_pages(spark, sf_dir, max_rows=None):
    ev = fx.table(spark, sf_dir, "events", spread=True, max_rows=max_rows)
    status, link, date, brief, tags = _card_raw_cols()

    def cv(title, value=None, text=None):
        return F.struct(
            F.struct(F.lit(title).alias("title")).alias("column"),
            (value if value is not None else F.lit(None).cast("string")).alias("value"),
            (text if text is not None else F.lit(None).cast("string")).alias("text"),
        )

    by_position = [cv("Status", status), cv("Link to page", link), cv("Date Published", date),
                   cv("Brief Card Description", brief), cv("Choose Tags", text=tags)]
    shuffled = [by_position[4], by_position[2], by_position[0], by_position[3], by_position[1]]
    item_a = F.struct(F.concat(F.lit("Card "), F.col("user_id").cast("string")).alias("name"), F.array(*by_position).alias("column_values"))
    item_b = F.struct(F.concat(F.lit("Brief "), (F.col("event_id") % 50).cast("string")).alias("name"), F.array(*shuffled).alias("column_values"))
    page = F.struct(
        F.struct(
            F.array(F.struct(F.struct(F.concat(F.lit("c"), F.col("event_id").cast("string")).alias("cursor"),
                                      F.array(item_a, item_b).alias("items")).alias("items_page"))).alias("boards")
        ).alias("data")
    )
    return ev.select("event_id", F.from_json(F.to_json(page), SC.CARD_PAGE).alias("p")).select("event_id", "p.data")


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_CARDS_SQL = f"""ev AS (
  SELECT event_id, user_id, event_type, ts,
         CASE WHEN event_type = 'error' THEN '{{"text":"none"}}'
              ELSE concat('{{"url":"https://cards.example.org/e', CAST(event_id AS VARCHAR), '","text":"Card"}}') END AS link,
         concat('{{"date":"', strftime(ts, '%Y-%m-%d'), '","changed_at":"', strftime(ts, '%Y-%m-%dT%H:%M:%S'), '"}}') AS date_v,
         concat('"  ', CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), ' ', event_type, ' card for user ', CAST(user_id AS VARCHAR), '"') AS brief,
         CASE {_K} % 5 WHEN 0 THEN 'Carbon, Solar' WHEN 1 THEN 'Water' WHEN 2 THEN NULL
              WHEN 3 THEN ' Methane,,Bonds ' ELSE 'Unknown Tag, Carbon' END AS tags
  FROM events),
items AS (
  SELECT event_id, 0 AS item_pos, concat('Card ', CAST(user_id AS VARCHAR)) AS title, link, date_v, brief, tags FROM ev
  UNION ALL
  SELECT event_id, 1, concat('Brief ', CAST(event_id % 50 AS VARCHAR)), link, date_v, brief, tags FROM ev),
cards AS (
  SELECT event_id, item_pos, title,
         CASE WHEN regexp_matches(link, {S.q(URL_PATTERN)}) THEN regexp_extract(link, {S.q(URL_PATTERN)}, 1) END AS url,
         CAST(CASE WHEN regexp_matches(date_v, {S.q(DATE_PATTERN)}) THEN regexp_extract(date_v, {S.q(DATE_PATTERN)}, 1) END AS DATE) AS pubDate,
         CASE WHEN regexp_matches(brief, {S.q(TEXT_PATTERN)}) THEN regexp_extract(brief, {S.q(TEXT_PATTERN)}, 1) END AS description,
         coalesce(tags, '') AS content_tags
  FROM items)"""


@query(
    "cards_flatten",
    f"WITH {_CARDS_SQL} SELECT event_id, item_pos, title, url, pubDate, description, content_tags FROM cards WHERE url IS NOT NULL",
)
def q_cards_flatten(spark, sf_dir):
    return flatten_cards(card_pages(spark, sf_dir), keep=["event_id"])


@query(
    "card_tags",
    f"""WITH {_CARDS_SQL}, {fx.REF_TAGS_SQL},
sp AS (
  SELECT c.event_id, c.item_pos, c.title, t.tag AS tag_raw, t.tag_pos
  FROM (SELECT * FROM cards WHERE url IS NOT NULL) c,
       unnest(string_split(c.content_tags, ',')) WITH ORDINALITY AS t(tag, tag_pos)),
st AS (SELECT event_id, item_pos, title, tag_pos, {S.strip('tag_raw')} AS tag FROM sp WHERE tag_raw <> ''),
j AS (SELECT st.*, r.guid AS tag_guid FROM st LEFT JOIN (SELECT DISTINCT tag, guid FROM ref_tags) r ON st.tag = r.tag)
SELECT title, tag, tag_guid FROM (
  SELECT *, row_number() OVER (PARTITION BY title, tag_guid ORDER BY tag_pos, event_id, item_pos, tag) AS rn FROM j)
WHERE rn = 1""",
)
def q_card_tags(spark, sf_dir):
    cards = flatten_cards(card_pages(spark, sf_dir, max_rows=PAYLOAD_ROWS), keep=["event_id"])
    return card_tags(cards, fx.ref_tags(spark), ["event_id", "item_pos"])


# ---------------------------------------------------------------- landing gaps (K8)


@query(
    "landing_gap_days",
    """WITH landed AS (
  SELECT DISTINCT concat(event_type, '-', CAST(user_id AS VARCHAR)) AS section, CAST(ts AS DATE) AS day FROM events),
ranges AS (SELECT section, min(day) AS d0, max(day) AS d1 FROM landed GROUP BY section),
expected AS (SELECT section, CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS day FROM ranges)
SELECT section, day FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.section = e.section AND l.day = e.day)""",
)
def q_landing_gap_days(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events", spread=True)
    landed = ev.select(
        F.concat(F.col("event_type"), F.lit("-"), F.col("user_id").cast("string")).alias("section"),
        F.to_date("ts").alias("day"),
    ).distinct()
    return landing_gaps(landed)


# ---------------------------------------------------------------- look-back window

LOOKBACK_AS_OF = "2024-01-20"
LOOKBACK_SECTIONS = ["click", "view"]


@query(
    "lookback_window",
    f"""SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value), 6) AS value
FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '{LOOKBACK_AS_OF}' - INTERVAL 5 DAY AND DATE '{LOOKBACK_AS_OF}'
  AND event_type IN ('click', 'view')
GROUP BY 1, 2""",
)
def q_lookback_window(spark, sf_dir):
    from newsflow.functions.dates import within_lookback

    ev = fx.table(spark, sf_dir, "events")
    sel = ev.where(within_lookback("ts", LOOKBACK_AS_OF, 5) & F.col("event_type").isin(LOOKBACK_SECTIONS))
    return sel.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("value")
    )


# ---------------------------------------------------------------- sampling (O3)


@query("sample_works", f"WITH works AS ({ORACLE['crossref_dates']}) SELECT * FROM works ORDER BY md5('42:' || url), url LIMIT 5")
def q_sample_works(spark, sf_dir):
    """Five random CrossRef works (the sample is the feature; top-5 per partition, then merged)."""
    from newsflow.operators.metrics import sample_rows

    return sample_rows(crossref_dates(_crossref_works(spark, sf_dir)), "url", 5, seed=42)
