"""Named queries for RSS profiles, HTML extraction and relative dates (step 8).

RSS items are derived from ``documents`` with the field shapes feeds carry
(RFC-822 dates, HTML fragments, title markers, several feeds per family);
XML parsing itself is covered by the unit tests, which write feed files.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from newsflow.functions import dates as D
from newsflow.plans import fixtures as fx
from newsflow.plans import sql_text as S
from newsflow.operators.partitioning import posexplode_rows
from newsflow.plans.registry import query
from newsflow.sources import html as H
from newsflow.sources.profiles import LOGO_IMG, PROFILES, SourceProfile, normalise

RFC = r"(\d{1,2} [A-Za-z]{3} \d{4})"
ISO = r"(\d{4}-\d{2}-\d{2})"


def _feed_keys(p: SourceProfile) -> list[str]:
    return list(p.feed_sources) or [p.name]


def rss_fixture(spark, sf_dir, keys: list[str]):
    d = fx.table(spark, sf_dir, "documents", spread=True)
    doc = F.col("doc_id")
    t = F.substring(F.get(F.split("text", "\n"), 0), 1, 120)
    day = F.date_add(F.lit("2024-01-01").cast("date"), (doc % 180).cast("int"))
    body = F.col("text")
    sid = doc.cast("string")
    return d.select(
        doc.alias("doc_id"),
        F.when(doc % 11 == 0, F.concat(F.lit("WATCH | "), t))
        .when(doc % 11 == 1, F.concat(F.lit("POLITICS | "), t))
        .when(doc % 11 == 2, F.concat(F.lit("CARTOON |"), t))
        .otherwise(t)
        .alias("title"),
        F.concat(F.lit("https://news.example.org/a/"), sid).alias("link"),
        F.col("lang").alias("author"),
        F.when(doc % 17 == 0, F.lit("not a date"))
        .otherwise(F.concat(F.date_format(day, "EEE, dd MMM yyyy"), F.lit(" 23:59:00 -0800")))
        .alias("published"),
        F.concat(day.cast("string"), F.lit("T08:00:00Z")).alias("updated"),
        F.when(
            doc % 5 == 0,
            F.concat(F.lit('<a href="https://news.example.org/i/'), sid, F.lit('"><img src="https://img.example.org/'), sid, F.lit('.jpg"/></a>'), body),
        )
        .when(doc % 5 == 1, F.concat(F.lit(LOGO_IMG + "<p>S&amp;P "), body, F.lit("</p><p>More</p>")))
        .otherwise(F.concat(F.lit("<p>"), body, F.lit("</p><p>Read more</p>")))
        .alias("summary"),
        F.element_at(F.array(*[F.lit(k) for k in keys]), (doc % len(keys) + 1).cast("int")).alias("feed"),
    )


def _rss_fixture_sql(keys: list[str]) -> str:
    t = "substring(string_split(text, chr(10))[1], 1, 120)"
    day = "CAST(DATE '2024-01-01' + CAST(doc_id % 180 AS INTEGER) AS DATE)"
    body = "text"
    sid = "CAST(doc_id AS VARCHAR)"
    key_list = "[" + ", ".join(S.q(k) for k in keys) + "]"
    return f"""items AS (
  SELECT doc_id,
         CASE doc_id % 11 WHEN 0 THEN 'WATCH | ' || {t} WHEN 1 THEN 'POLITICS | ' || {t}
              WHEN 2 THEN 'CARTOON |' || {t} ELSE {t} END AS title,
         'https://news.example.org/a/' || {sid} AS link,
         lang AS author,
         CASE WHEN doc_id % 17 = 0 THEN 'not a date' ELSE strftime({day}, '%a, %d %b %Y') || ' 23:59:00 -0800' END AS published,
         CAST({day} AS VARCHAR) || 'T08:00:00Z' AS updated,
         CASE doc_id % 5
           WHEN 0 THEN '<a href="https://news.example.org/i/' || {sid} || '"><img src="https://img.example.org/' || {sid} || '.jpg"/></a>' || {body}
           WHEN 1 THEN {S.q(LOGO_IMG + "<p>S&amp;P ")} || {body} || '</p><p>More</p>'
           ELSE '<p>' || {body} || '</p><p>Read more</p>' END AS summary,
         {key_list}[doc_id % {len(keys)} + 1] AS feed
  FROM documents)"""


def _date_sql(x: str) -> str:
    return (
        f"CAST(coalesce(try_strptime(regexp_extract({x}, '{RFC}', 1), '%d %b %Y'), "
        f"try_strptime(regexp_extract({x}, '{ISO}', 1), '%Y-%m-%d')) AS DATE)"
    )


def profile_sql(p: SourceProfile) -> str:
    keys = _feed_keys(p)
    where = ""
    if p.title_drop_markers:
        where = "WHERE NOT (" + " OR ".join(f"coalesce(contains(title, {S.q(m)}), false)" for m in p.title_drop_markers) + ")"
    title = (
        S.strip("CASE WHEN contains(title, '|') THEN string_split(title, '|')[2] ELSE title END") if p.title_after_bar else "title"
    )
    date = {"feed": _date_sql("published"), "prefix16": _date_sql("substring(published, 1, 16)"), "updated": _date_sql("updated")}[
        p.date_rule
    ]
    desc = "summary"
    for op in p.text_ops:
        if op[0] == "before":
            desc = f"split_part({desc}, {S.q(op[1])}, 1)"
        elif op[0] == "after":
            desc = f"string_split({desc}, {S.q(op[1])})[2]"
        elif op[0] == "remove":
            desc = f"replace({desc}, {S.q(op[1])}, '')"
        elif op[0] == "strip":
            desc = S.strip(desc)
    if p.feed_sources:
        source = "CASE feed " + " ".join(f"WHEN {S.q(k)} THEN {S.q(v)}" for k, v in p.feed_sources.items()) + " ELSE feed END"
    else:
        source = S.q(p.source)
    creators = {"author": "author", "": "''", None: "CAST(NULL AS VARCHAR)"}[p.creators]
    body = f"""SELECT doc_id, {title} AS title, link AS url, {date} AS pubDate, {desc} AS description,
       {creators} AS creators, {source} AS source
FROM items {where}"""
    if p.dedup_title:
        body = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY doc_id) AS rn FROM ({body})) WHERE rn = 1"""
    return f"WITH {_rss_fixture_sql(keys)}\nSELECT title, url, pubDate, description, creators, source FROM ({body})"


def _register_profile(p: SourceProfile) -> None:
    keys = _feed_keys(p)

    def run(spark, sf_dir, _p=p, _keys=keys):
        return normalise(rss_fixture(spark, sf_dir, _keys), _p, order=["doc_id"])

    query(f"rss_{p.name}", profile_sql(p))(run)


for _p in PROFILES.values():
    _register_profile(_p)


# ---------------------------------------------------------------- HTML


@query(
    "html_links",
    f"""SELECT page_id, CAST(t.pos - 1 AS INTEGER) AS link_pos, t.href
FROM pages, unnest(regexp_extract_all(html, {S.q(H.HREF_PATTERN)}, 1)) WITH ORDINALITY AS t(href, pos)
WHERE starts_with(t.href, '/')""",
)
def q_html_links(spark, sf_dir):
    return H.links(fx.table(spark, sf_dir, "pages", spread=True))


PAGE_HEADING = r"<h1>([^<]*)</h1>"
PAGE_PARAGRAPH = r"<p>([^<]+)</p>"
PAGE_AD_BLOCK = r'<div class="ad">[^<]*</div>'


def _unescape_sql(x: str) -> str:
    for a, b in H.ENTITIES:
        x = f"replace({x}, {S.q(a)}, {S.q(b)})"
    return x


@query(
    "html_teasers",
    f"""WITH z AS (
  SELECT page_id,
         regexp_extract_all(regexp_replace(html, {S.q(PAGE_AD_BLOCK)}, '', 'g'), {S.q(PAGE_HEADING)}, 1) AS h,
         regexp_extract_all(regexp_replace(html, {S.q(PAGE_AD_BLOCK)}, '', 'g'), {S.q(PAGE_PARAGRAPH)}, 1) AS s
  FROM pages),
pairs AS (
  SELECT page_id, CAST(i - 1 AS INTEGER) AS item_pos,
         {_unescape_sql(f"regexp_replace(h[i], '{H.TAG_PATTERN}', '', 'g')")} AS title,
         {_unescape_sql(f"regexp_replace(s[i], '{H.TAG_PATTERN}', '', 'g')")} AS description
  FROM z, range(1, greatest(len(h), len(s)) + 1) AS r(i)),
kept AS (
  SELECT * FROM pairs
  WHERE nullif(title, '') IS NOT NULL
    AND NOT (coalesce(contains(title, 'FT Crossword') OR contains(title, 'Quiz'), false)
          OR coalesce(contains(description, 'FT Crossword') OR contains(description, 'Quiz'), false))),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY page_id, item_pos) AS rn FROM kept) WHERE rn = 1)
SELECT title, nullif(description, '') AS description, DATE '{fx.AS_OF}' AS pubDate, 'Financial Times' AS source,
       'https://www.ft.com/news-feed' AS url
FROM firsts WHERE NOT contains(title, 'Letter: ')""",
)
def q_html_teasers(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages", spread=True)
    return H.teasers(pages, fx.AS_OF, heading=PAGE_HEADING, standfirst=PAGE_PARAGRAPH, drop_block=PAGE_AD_BLOCK, extract=H.zipped_extract)


PAGE_NAV_CARD = r"<li>(<a [^>]*>[^<]*</a>)</li>"
PAGE_CARD_FIELDS = {"link": r'href="([^"]*)"', "title": r">([^<]*)</a>"}


@query(
    "html_cards",
    f"""WITH cards AS (
  SELECT page_id, CAST(t.pos - 1 AS INTEGER) AS card_pos, t.card, regexp_extract(url, '^https?://([^/]+)', 1) AS host
  FROM pages, unnest(regexp_extract_all(html, {S.q(PAGE_NAV_CARD)}, 1)) WITH ORDINALITY AS t(card, pos)),
f AS (
  SELECT page_id, card_pos, host,
         CASE WHEN regexp_matches(card, {S.q(PAGE_CARD_FIELDS['link'])}) THEN regexp_extract(card, {S.q(PAGE_CARD_FIELDS['link'])}, 1) END AS url,
         {_unescape_sql(f"regexp_replace(CASE WHEN regexp_matches(card, '{PAGE_CARD_FIELDS['title']}') THEN regexp_extract(card, '{PAGE_CARD_FIELDS['title']}', 1) END, '{H.TAG_PATTERN}', '', 'g')")} AS title
  FROM cards)
SELECT page_id, card_pos, title, url, host AS source FROM f""",
)
def q_html_cards(spark, sf_dir):
    from newsflow.functions import text as X

    pages = fx.table(spark, sf_dir, "pages", spread=True)
    cards = posexplode_rows(
        pages,
        F.regexp_extract_all("html", F.lit(PAGE_NAV_CARD), 1),
        ["page_id", F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("source")],
        "card_pos",
        "card",
    )
    return cards.select(
        "page_id",
        "card_pos",
        H.text_of(X.regexp_extract_or_null("card", PAGE_CARD_FIELDS["title"])).alias("title"),
        X.regexp_extract_or_null("card", PAGE_CARD_FIELDS["link"]).alias("url"),
        "source",
    )


# ---------------------------------------------------------------- relative dates

REL_AS_OF = "2024-03-05 01:00:00"


@query(
    "relative_dates",
    f"""WITH r AS (
  SELECT event_id,
         CASE event_id % 4
           WHEN 0 THEN CAST(CAST(floor(value) AS BIGINT) % 48 AS VARCHAR) || ' hours ago'
           WHEN 1 THEN CAST(CAST(floor(value) AS BIGINT) % 90 AS VARCHAR) || ' minutes ago'
           WHEN 2 THEN 'LIVE'
           ELSE strftime(ts, '%b %-d, %Y') END AS rel,
         CAST(floor(value) AS BIGINT) AS n, ts
  FROM events)
SELECT event_id, rel,
       CASE event_id % 4
         WHEN 0 THEN CAST(TIMESTAMP '{REL_AS_OF}' - (n % 48) * INTERVAL 1 HOUR AS DATE)
         WHEN 1 THEN CAST(TIMESTAMP '{REL_AS_OF}' - (n % 90) * INTERVAL 1 MINUTE AS DATE)
         WHEN 2 THEN CAST(TIMESTAMP '{REL_AS_OF}' AS DATE)
         ELSE CAST(ts AS DATE) END AS pubDate
FROM r""",
)
def q_relative_dates(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events", spread=True)
    n = F.floor("value").cast("bigint")
    k = F.col("event_id") % 4
    rel = (
        F.when(k == 0, F.concat((n % 48).cast("string"), F.lit(" hours ago")))
        .when(k == 1, F.concat((n % 90).cast("string"), F.lit(" minutes ago")))
        .when(k == 2, F.lit("LIVE"))
        .otherwise(F.date_format("ts", "MMM d, yyyy"))
    )
    return ev.select("event_id", rel.alias("rel")).select("event_id", "rel", D.relative_date("rel", REL_AS_OF).alias("pubDate"))
