"""Named queries for the tagger (step 1 of the build plan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.operators.tagging import char_limit_frame, tag_articles, tag_category_hits, with_description_fallback
from newsflow.plans import fixtures as fx
from newsflow.plans.registry import query
from newsflow.plans.sql_tagging import CATEGORY_LIST, TAGGED_CTES, tagger_ctes
from newsflow.schemas import ALL_CATEGORIES, ALL_CATEGORY_COLUMNS


def tagged_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_articles(fx.articles(spark, sf_dir), fx.ref_tags(spark))


@query("char_limit", f"WITH {TAGGED_CTES} SELECT char_limit, n_sources FROM cap")
def q_char_limit(spark, sf_dir):
    return char_limit_frame(with_description_fallback(fx.articles(spark, sf_dir)))


@query("tag_articles_wide", f"WITH {TAGGED_CTES} SELECT id, {CATEGORY_LIST}, tag_concat, tag_score FROM tagged")
def q_tag_articles_wide(spark, sf_dir):
    return tagged_articles(spark, sf_dir).select("id", *ALL_CATEGORY_COLUMNS, "tag_concat", "tag_score")


@query(
    "tag_category_hits",
    f"""WITH {TAGGED_CTES}
SELECT id, tag_cat, tag FROM (SELECT DISTINCT id, tag_cat, tag FROM hits)""",
)
def q_tag_category_hits(spark, sf_dir):
    return tag_category_hits(fx.articles(spark, sf_dir), fx.ref_tags(spark))


@query(
    "tag_score",
    f"""WITH {TAGGED_CTES}
SELECT tag_score, count(*) AS n_articles, count(DISTINCT tag_concat) AS n_tag_sets FROM tagged GROUP BY tag_score""",
)
def q_tag_score(spark, sf_dir):
    return (
        tagged_articles(spark, sf_dir)
        .groupBy("tag_score")
        .agg(F.count("*").alias("n_articles"), F.countDistinct("tag_concat").alias("n_tag_sets"))
    )


@query(
    "tag_concat",
    f"WITH {TAGGED_CTES} SELECT id, title, description, tag_concat, tag_score FROM tagged WHERE tag_concat IS NOT NULL",
)
def q_tag_concat(spark, sf_dir):
    return (
        tagged_articles(spark, sf_dir)
        .where(F.col("tag_concat").isNotNull())
        .select("id", "title", "description", "tag_concat", "tag_score")
    )


_COVERAGE_SQL_COLS = ",\n       ".join(f"count({c}) AS n_{c}" for _, c in ALL_CATEGORIES)


def category_coverage_by_source(tagged: DataFrame) -> DataFrame:
    """Per source: articles, articles per category, mean score (flagship report)."""
    return tagged.groupBy("source").agg(
        F.count("*").alias("n_articles"),
        *[F.count(c).alias(f"n_{c}") for _, c in ALL_CATEGORIES],
        F.count("tag_score").alias("n_tagged"),
        F.round(F.avg("tag_score"), 6).alias("mean_score"),
    )


@query(
    "category_coverage_by_source",
    f"""WITH {TAGGED_CTES}
SELECT source, count(*) AS n_articles,
       {_COVERAGE_SQL_COLS},
       count(tag_score) AS n_tagged,
       round(avg(tag_score), 6) AS mean_score
FROM tagged GROUP BY source""",
)
def q_category_coverage_by_source(spark, sf_dir):
    return category_coverage_by_source(tagged_articles(spark, sf_dir))


# ---------------------------------------------------------------- a dictionary beyond the inline bound

_MANY = f"""{fx.ARTICLES_SQL},
words AS (SELECT list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda x: x <> '') AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT unnest(list_concat(list_filter(w, lambda x: length(x) >= 3), list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS phrase FROM words),
many AS (SELECT 0 AS ref_seq, 'Sector' AS tag_cat, phrase AS tag, phrase, 'Yes' AS newsroom FROM phrases),
{tagger_ctes('m_', 'articles', 'many')}"""


def many_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of three letters or more and every pair of neighbouring words of the benchmark items."""
    words = F.array_remove(F.split(F.lower("text"), "[^a-z]+"), "")
    rows = fx.table(spark, sf_dir, "benchmark").select(words.alias("w"))
    pairs = F.transform(F.slice("w", 2, F.size("w")), lambda x, i: F.concat_ws(" ", F.get(F.col("w"), i), x))
    phrase = rows.select(F.explode(F.concat(F.filter("w", lambda x: F.length(x) >= 3), pairs)).alias("phrase")).distinct()
    return phrase.select(F.lit(0).alias("ref_seq"), F.md5("phrase").alias("guid"), F.lit("Sector").alias("tag_cat"), F.col("phrase").alias("tag"), "phrase", F.lit("Yes").alias("newsroom"))


@query("tag_articles_many_phrases", f"WITH {_MANY} SELECT id, tag_concat, tag_score FROM m_tagged")
def q_tag_articles_many_phrases(spark, sf_dir):
    arts = fx.articles(spark, sf_dir)
    return tag_articles(arts, many_phrases(spark, sf_dir)).select("id", "tag_concat", "tag_score")
