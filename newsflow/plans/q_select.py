"""Named queries for the co-occurrence selector and its reports (step 5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsflow.functions import text as X
from newsflow.operators.clean import DEFAULT_REQUEST_PREFIX
from newsflow.operators.cooccurrence import content_flags, cooccurrence_ids, recent_report, report, subject_ids
from newsflow.operators.tags_long import to_long
from newsflow.plans import fixtures as fx
from newsflow.plans import sql_text as S
from newsflow.plans.q_tagging import tagged_articles
from newsflow.plans.q_tags import LONG_CTES
from newsflow.plans.registry import query
from newsflow.schemas import ALL_CATEGORIES, ALL_CATEGORY_COLUMNS

PROGRAMME = "Oil Refining"

_ALL = ", ".join(c for _, c in ALL_CATEGORIES)

# The selector's content tags carry every category, Current Issues included.
SELECT_CTES = f"""{LONG_CTES},
ct AS (
  SELECT DISTINCT u.id AS content_id, t.tag FROM (
    UNPIVOT (SELECT id, {_ALL} FROM tagged WHERE tag_concat IS NOT NULL OR current_issues IS NOT NULL)
    ON {_ALL} INTO NAME src_col VALUE tags) AS u, unnest(string_split(u.tags, ',')) AS t(tag)
  WHERE u.tags <> '' AND t.tag <> ''),
g AS (SELECT ct.content_id, r.guid FROM ct LEFT JOIN (SELECT DISTINCT tag, guid FROM ref_tags) r ON ct.tag = r.tag),
prog AS (
  SELECT p.tag_guid, r.tag_cat FROM profiles p
  LEFT JOIN (SELECT DISTINCT guid, tag_cat FROM ref_tags) r ON p.tag_guid IS NOT DISTINCT FROM r.guid
  WHERE p.cost_center = {S.q(PROGRAMME)}),
subj AS (SELECT DISTINCT tag_guid FROM prog
         WHERE tag_cat IS DISTINCT FROM 'Adaptation' AND tag_cat IS DISTINCT FROM 'Current Issues'),
iss AS (SELECT DISTINCT tag_guid FROM prog WHERE tag_cat = 'Current Issues'),
matched AS (SELECT g.content_id, g.guid FROM g JOIN (SELECT DISTINCT tag_guid FROM prog) p ON g.guid IS NOT DISTINCT FROM p.tag_guid),
flags AS (
  SELECT content_id,
         bool_or(EXISTS (SELECT 1 FROM subj s WHERE s.tag_guid IS NOT DISTINCT FROM matched.guid)) AS has_subject,
         bool_or(EXISTS (SELECT 1 FROM iss i WHERE i.tag_guid IS NOT DISTINCT FROM matched.guid)) AS has_issue
  FROM matched GROUP BY content_id),
content AS (
  SELECT id, title, source, pubDate, description, tag_concat, tag_score,
         concat({S.q(DEFAULT_REQUEST_PREFIX)}, {S.quote_plus(S.file_title('title'))}) AS url_request
  FROM tagged)"""


def _content(spark, sf_dir):
    t = tagged_articles(spark, sf_dir)
    return t.select(
        "id", "title", "source", "pubDate", "description", "tag_concat", "tag_score",
        X.request_url(DEFAULT_REQUEST_PREFIX, X.file_title("title")).alias("url_request"),
    )


def _flags(spark, sf_dir):
    tagged = tagged_articles(spark, sf_dir).where(F.col("tag_concat").isNotNull() | F.col("current_issues").isNotNull())
    ct = to_long(tagged, categories=ALL_CATEGORY_COLUMNS).select("content_id", "tag")
    return content_flags(ct, fx.ref_tags(spark), fx.profiles(spark), PROGRAMME)


@query("cooccurrence_ids", f"WITH {SELECT_CTES} SELECT content_id FROM flags WHERE has_subject AND has_issue")
def q_cooccurrence_ids(spark, sf_dir):
    return cooccurrence_ids(_flags(spark, sf_dir))


@query("subject_ids", f"WITH {SELECT_CTES} SELECT content_id FROM flags WHERE has_subject")
def q_subject_ids(spark, sf_dir):
    return subject_ids(_flags(spark, sf_dir))


@query(
    "cooccurrence_report",
    f"""WITH {SELECT_CTES}
SELECT id, title, source, pubDate, substring(description, 1, 500) || '...' AS description, tag_concat, url_request
FROM content WHERE id IN (SELECT content_id FROM flags WHERE has_subject AND has_issue)""",
)
def q_cooccurrence_report(spark, sf_dir):
    return report(_content(spark, sf_dir), cooccurrence_ids(_flags(spark, sf_dir)))


@query(
    "recent_subject_report",
    f"""WITH {SELECT_CTES}
SELECT id, title, source, pubDate, substring(description, 1, 500) || '...' AS description, tag_concat,
       url_request, tag_score
FROM content
WHERE tag_score > 1 AND pubDate > DATE '{fx.AS_OF}' - INTERVAL 90 DAY
  AND id IN (SELECT content_id FROM flags WHERE has_subject)""",
)
def q_recent_subject_report(spark, sf_dir):
    return recent_report(_content(spark, sf_dir), subject_ids(_flags(spark, sf_dir)), fx.AS_OF)
