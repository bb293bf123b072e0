"""DuckDB SQL for the tagger, written independently of the Spark operator."""

from __future__ import annotations

from newsflow.plans.fixtures import ARTICLES_SQL, PROFILES_SQL, REF_TAGS_SQL
from newsflow.schemas import ALL_CATEGORIES, SCORED_CATEGORIES

CATEGORY_LIST = ", ".join(col for _, col in ALL_CATEGORIES)


def tagger_ctes(p: str, source: str, ref: str) -> str:
    """CTEs ``{p}arts, {p}cap, {p}hits, {p}tagged`` tagging ``source`` with phrases of ``ref``."""
    wide_cols = ",\n         ".join(f"max(tags) FILTER (WHERE tag_cat = '{cat}') AS {col}" for cat, col in ALL_CATEGORIES)
    concat = ", ".join(f"{p}wide.{c}" for _, c in SCORED_CATEGORIES)
    score = " + ".join(f"CAST({p}wide.{c} IS NOT NULL AS INTEGER)" for _, c in SCORED_CATEGORIES)
    return f"""{p}dict AS (
  SELECT tag_cat, phrase, tag FROM (
    SELECT tag_cat, tag, lower(phrase) AS phrase,
           row_number() OVER (PARTITION BY tag_cat, lower(phrase) ORDER BY ref_seq DESC) AS rn
    FROM {ref} WHERE newsroom = 'Yes') WHERE rn = 1),
{p}arts AS (SELECT * REPLACE (coalesce(description, title) AS description) FROM {source}),
{p}cap AS (
  SELECT CAST(round_even(avg(m), 0) AS INTEGER) AS char_limit, count(*) AS n_sources
  FROM (SELECT source, avg(length(description)) AS m FROM {p}arts WHERE source IS NOT NULL GROUP BY source)),
{p}matchable AS (
  SELECT a.id, lower(substring(a.description, 1, c.char_limit)) AS desc_match
  FROM {p}arts a CROSS JOIN {p}cap c),
{p}hits AS (
  SELECT m.id, d.tag_cat, d.tag FROM {p}matchable m JOIN {p}dict d ON contains(m.desc_match, d.phrase)),
{p}cells AS (
  SELECT id, tag_cat, string_agg(DISTINCT tag, ',' ORDER BY tag) AS tags FROM {p}hits GROUP BY id, tag_cat),
{p}wide AS (
  SELECT id AS wid,
         {wide_cols}
  FROM {p}cells GROUP BY id),
{p}tagged AS (
  SELECT a.*, {p}wide.* EXCLUDE (wid),
         nullif(concat_ws(',', {concat}), '') AS tag_concat,
         CAST(nullif({score}, 0) AS INTEGER) AS tag_score
  FROM {p}arts a LEFT JOIN {p}wide ON a.id = {p}wide.wid)"""


TAGGED_CTES = f"""{ARTICLES_SQL},
{REF_TAGS_SQL},
{PROFILES_SQL},
{tagger_ctes('', 'articles', 'ref_tags')}"""
