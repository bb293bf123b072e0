"""Named queries for the tag normaliser and programme roll-up (step 4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsflow.operators.load import update_by_key
from newsflow.operators.tagging import tag_category_hits
from newsflow.operators.tags_long import (
    active_profiles,
    attach_guid,
    import_profiles,
    tag_transform,
    to_long,
)
from newsflow.plans import fixtures as fx
from newsflow.plans import sql_text as S
from newsflow.plans.q_tagging import tagged_articles
from newsflow.plans.registry import query
from newsflow.plans.sql_tagging import TAGGED_CTES
from newsflow.schemas import SCORED_CATEGORIES

_COLS = ", ".join(c for _, c in SCORED_CATEGORIES)
_NAME_CASE = "CASE src_col " + " ".join(f"WHEN '{c}' THEN {S.q(n)}" for n, c in SCORED_CATEGORIES) + " END"
_RANK_CASE = "CASE src_col " + " ".join(f"WHEN '{c}' THEN {i}" for i, (_, c) in enumerate(SCORED_CATEGORIES)) + " END"
_EXCL = " AND ".join(f"cost_center IS DISTINCT FROM {S.q(p)}" for p in fx.EXCLUDED_PROGRAMMES)

LONG_CTES = f"""{TAGGED_CTES},
existing AS (SELECT id AS content_id FROM tagged WHERE tag_concat IS NOT NULL AND id % 3 = 0),
melted AS (
  SELECT id AS content_id, src_col, tags FROM (
    UNPIVOT (SELECT id, {_COLS} FROM tagged WHERE tag_concat IS NOT NULL)
    ON {_COLS} INTO NAME src_col VALUE tags)
  WHERE tags IS NOT NULL AND tags <> ''),
long AS (
  SELECT content_id, {_NAME_CASE} AS tag_cat, {_RANK_CASE} AS cat_rank, CAST(t.pos - 1 AS INTEGER) AS pos, t.tag
  FROM melted, unnest(string_split(tags, ',')) WITH ORDINALITY AS t(tag, pos)
  WHERE t.tag IS NOT NULL AND t.tag <> ''),
ref_guid AS (SELECT DISTINCT tag, tag_cat, guid FROM ref_tags),
guided AS (
  SELECT content_id, tag_cat, tag, tag_guid, pos, cat_rank FROM (
    SELECT l.content_id, l.tag, r.tag_cat, r.guid AS tag_guid, l.pos, l.cat_rank,
           row_number() OVER (PARTITION BY l.content_id, r.guid ORDER BY l.pos, l.cat_rank, l.tag, r.tag_cat) AS rn
    FROM long l LEFT JOIN ref_guid r ON l.tag = r.tag) WHERE rn = 1),
new_guided AS (
  SELECT content_id, tag, tag_guid, pos, cat_rank FROM (
    SELECT l.content_id, l.tag, r.tag_cat, r.guid AS tag_guid, l.pos, l.cat_rank,
           row_number() OVER (PARTITION BY l.content_id, r.guid ORDER BY l.pos, l.cat_rank, l.tag, r.tag_cat) AS rn
    FROM long l LEFT JOIN ref_guid r ON l.tag = r.tag
    WHERE l.content_id NOT IN (SELECT content_id FROM existing)) WHERE rn = 1),
new_guided_cat AS (
  SELECT g.content_id, r.tag_cat, g.tag, g.tag_guid FROM (
    SELECT content_id, tag, tag_guid FROM new_guided) g
  LEFT JOIN (SELECT DISTINCT tag, tag_cat, guid FROM ref_tags) r ON g.tag = r.tag AND g.tag_guid = r.guid),
prof AS (SELECT cost_center, tag_guid FROM profiles WHERE {_EXCL}),
with_prog AS (
  SELECT g.content_id, g.tag_cat, g.tag, g.tag_guid, coalesce(p.cost_center, '') AS cost_center
  FROM new_guided_cat g LEFT JOIN prof p ON g.tag_guid IS NOT DISTINCT FROM p.tag_guid),
rollup AS (
  SELECT content_id, profiles FROM (
    SELECT content_id, string_agg(DISTINCT cost_center, ', ' ORDER BY cost_center) AS profiles
    FROM with_prog WHERE cost_center <> '' GROUP BY content_id)
  WHERE profiles <> '' AND profiles NOT IN ({", ".join(S.q(p) for p in fx.EXCLUDED_PROGRAMMES)}))"""


def _tagged_content(spark, sf_dir):
    return tagged_articles(spark, sf_dir).where(F.col("tag_concat").isNotNull())


def _existing(spark, sf_dir):
    # ids already in the content-tag table; untagged ids among them never meet
    # the tagged side of the anti join, so the plain article ids give the same rows
    return fx.articles(spark, sf_dir).where(F.col("id") % 3 == 0).select(F.col("id").alias("content_id"))


@query("tags_long", f"WITH {LONG_CTES} SELECT content_id, tag_cat, cat_rank, pos, tag FROM long")
def q_tags_long(spark, sf_dir):
    return to_long(_tagged_content(spark, sf_dir))


@query("tags_with_guid", f"WITH {LONG_CTES} SELECT content_id, tag_cat, tag, tag_guid FROM guided")
def q_tags_with_guid(spark, sf_dir):
    g = attach_guid(to_long(_tagged_content(spark, sf_dir)), fx.ref_tags(spark))
    return g.select("content_id", "tag_cat", "tag", "tag_guid")


def _transform(spark, sf_dir):
    tagged = _tagged_content(spark, sf_dir)
    return tag_transform(tagged, _existing(spark, sf_dir), fx.ref_tags(spark), fx.profiles(spark), fx.EXCLUDED_PROGRAMMES)


@query(
    "tags_with_programmes",
    f"WITH {LONG_CTES} SELECT content_id, tag_cat, tag, tag_guid, cost_center FROM with_prog",
)
def q_tags_with_programmes(spark, sf_dir):
    return _transform(spark, sf_dir)[0]


@query("programme_rollup", f"WITH {LONG_CTES} SELECT content_id, profiles FROM rollup")
def q_programme_rollup(spark, sf_dir):
    return _transform(spark, sf_dir)[1]


@query(
    "upsert_profiles",
    f"""WITH {LONG_CTES}
SELECT t.id, t.title, r.profiles FROM tagged t LEFT JOIN rollup r ON t.id = r.content_id""",
)
def q_upsert_profiles(spark, sf_dir):
    content = tagged_articles(spark, sf_dir).select("id", "title", F.lit(None).cast("string").alias("profiles"))
    updates = _transform(spark, sf_dir)[1].withColumnRenamed("content_id", "id")
    return update_by_key(content, updates, "id", ["profiles"])


@query(
    "tag_metrics",
    f"""WITH {LONG_CTES}
SELECT (SELECT count(DISTINCT content_id) FROM new_guided) AS n_new_content,
       (SELECT count(*) FROM new_guided WHERE tag_guid IS NULL) AS n_without_guid,
       (SELECT count(DISTINCT cost_center) FROM prof) AS n_programmes,
       (SELECT count(*) FROM with_prog WHERE cost_center = '') AS n_without_programme,
       (SELECT count(*) FROM with_prog) AS n_rows_to_import,
       (SELECT count(*) FROM rollup) AS n_profiles""",
)
def q_tag_metrics(spark, sf_dir):
    rows, _ = _transform(spark, sf_dir)
    programmes = active_profiles(fx.profiles(spark), fx.EXCLUDED_PROGRAMMES).agg(F.countDistinct("cost_center").alias("n_programmes"))
    # one pass over the content-tag rows; a content id has a roll-up row exactly
    # when one of its rows matched a programme (excluded ones are filtered already)
    r = rows.agg(
        F.countDistinct("content_id").alias("n_new_content"),
        F.count_if(F.col("tag_guid").isNull()).alias("n_without_guid"),
        F.count_if(F.col("cost_center") == "").alias("n_without_programme"),
        F.count("*").alias("n_rows_to_import"),
        F.countDistinct(F.when(F.col("cost_center") != "", F.col("content_id"))).alias("n_profiles"),
    )
    one = r.unionByName(programmes, allowMissingColumns=True)
    return one.agg(*[F.max(c).alias(c) for c in ["n_new_content", "n_without_guid", "n_programmes", "n_without_programme", "n_rows_to_import", "n_profiles"]])


_SHEET_SQL = f"""{TAGGED_CTES},
sheet AS (
  SELECT a.id AS sheet_row, d.tag_cat,
         CASE WHEN a.id % 11 = 0 THEN concat(d.tag, ' (old)') ELSE d.tag END AS tag,
         coalesce(a.source, 'unassigned') AS program
  FROM (SELECT DISTINCT id, tag_cat, tag FROM hits) d JOIN arts a ON a.id = d.id),
imported AS (
  SELECT cost_center, tag_guid FROM (
    SELECT s.program AS cost_center, r.guid AS tag_guid,
           row_number() OVER (PARTITION BY r.guid ORDER BY s.sheet_row, s.tag_cat, s.program) AS rn
    FROM sheet s LEFT JOIN (SELECT tag, guid FROM ref_tags) r ON s.tag = r.tag) WHERE rn = 1)"""


@query("profile_import", f"WITH {_SHEET_SQL} SELECT cost_center, tag_guid FROM imported")
def q_profile_import(spark, sf_dir):
    arts = fx.articles(spark, sf_dir)
    hits = tag_category_hits(arts, fx.ref_tags(spark))
    sheet = hits.join(arts.select("id", "source"), "id").select(
        F.col("id").alias("sheet_row"),
        "tag_cat",
        F.when(F.col("id") % 11 == 0, F.concat("tag", F.lit(" (old)"))).otherwise(F.col("tag")).alias("tag"),
        F.coalesce("source", F.lit("unassigned")).alias("program"),
    )
    return import_profiles(sheet, fx.ref_tags(spark), ["sheet_row", "tag_cat"])
