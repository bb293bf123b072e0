"""Article-model inputs derived from the generic test tables.

Each derivation exists twice: as Spark DataFrame code and as a DuckDB SQL
common-table expression, so a query and its oracle start from the same rows.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession

from newsflow.operators.partitioning import bound_task_rows, ensure_parallelism
from newsflow.schemas import PROFILES, REF_TAGS

# Reference tag rows (ref_seq, guid, tag_cat, tag, phrase, newsroom).
REF_TAG_ROWS = [
    (1, "g01", "Adaptation", "Resilience", "attion", "Yes"),
    (2, "g02", "Behavior", "Demand", "anha", "Yes"),
    (3, "g03", "Emissions", "Carbon", "Rely", "Yes"),
    (4, "g04", "Emissions", "Methane", "thanea", "Yes"),
    (5, "g05", "Environment", "Water", "eriner", "Yes"),
    (6, "g06", "Finance", "Bonds", "thanedble", "Yes"),
    (7, "g07", "Geography", "France", "pour", "Yes"),
    (8, "g07", "Geography", "France", "avec", "Yes"),
    (9, "g08", "Geography", "Germany", "nicht", "Yes"),
    (10, "g09", "Industry", "Steel", "keit", "Yes"),
    (11, "g10", "Intervention", "Retrofit", "heit", "Yes"),
    (12, "g11", "Policy", "Carbon Markets", "para", "Yes"),
    (13, "g12", "Sector", "Buildings", "onesnt", "Yes"),
    (14, "g13", "Sector", "Mobility", "onesnt", "Yes"),
    (15, "g14", "Technology", "Solar", "thintion", "Yes"),
    (16, "g15", "Theory of Change", "Leverage", "onbleea", "Yes"),
    (17, "g16", "Climate Summits/Conferences", "COP", "zzqqzz", "Yes"),
    (18, "g17", "Organizational Components", "Staff", "erreth", "Yes"),
    (19, "g18", "Current Issues", "Protest", "idiot", "Yes"),
    (20, "g19", "Finance", "Insurance", "the", "No"),
]

# Programme profiles (cost_center, tag_guid).
PROFILE_ROWS = [
    ("Buildings", "g12"),
    ("Buildings", "g13"),
    ("Markets", "g06"),
    ("Markets", "g11"),
    ("Finance", "g06"),
    ("Oil Refining", "g03"),
    ("Oil Refining", "g04"),
    ("Oil Refining", "g18"),
    ("Oil Refining", "g01"),
    ("House", "g09"),
    ("Global South", "g07"),
    ("Orphans", None),
]

EXCLUDED_PROGRAMMES = ["House", "Oil Refining"]
EXCLUDED_SOURCES = ["src0", "src1", "src2"]
AS_OF = "2024-07-01"


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False, max_rows: int | None = None) -> DataFrame:
    """A test table; ``spread`` stands in for a landing directory of many files.

    The test tables are single row-group files (one scan task); fixtures that
    build and parse payloads row by row spread the scan over the cores.  With
    ``max_rows`` the number of tasks grows with the table, for fixtures whose
    payloads are sorted in the same task.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if max_rows:
        return bound_task_rows(df, max_rows)
    return ensure_parallelism(df) if spread else df


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", spread=True)
    title = "substring(split(text, '\\n')[0], 1, 120)"
    return d.selectExpr(
        "doc_id AS id",
        f"{title} AS title",
        f"CASE WHEN doc_id % 10 = 0 THEN CAST(NULL AS STRING) WHEN doc_id % 7 = 0 THEN concat({title}, '. ', text) ELSE text END AS description",
        "CASE WHEN doc_id % 97 = 0 THEN CAST(NULL AS STRING) ELSE source END AS source",
        "date_add(DATE '2024-01-01', CAST(doc_id % 180 AS INT)) AS pubDate",
        "lang AS creators",
        "concat('https://example.org/', CAST(doc_id AS STRING)) AS url",
    )


_DIMENSIONS: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def _dimension(spark: SparkSession, name: str, rows, ddl: str) -> DataFrame:
    """Fixed dimension tables, built once per session (the same DataFrame object)."""
    per_session = _DIMENSIONS.setdefault(spark, {})
    if name not in per_session:
        per_session[name] = spark.createDataFrame(rows, ddl)
    return per_session[name]


def ref_tags(spark: SparkSession) -> DataFrame:
    return _dimension(spark, "ref_tags", REF_TAG_ROWS, REF_TAGS)


def profiles(spark: SparkSession) -> DataFrame:
    return _dimension(spark, "profiles", PROFILE_ROWS, PROFILES)


def _sql_str(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, (int, float)):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


def _values(rows, cols) -> str:
    body = ",\n    ".join("(" + ", ".join(_sql_str(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES\n    {body}) AS t({', '.join(cols)}))"


ARTICLES_SQL = """articles AS (
  SELECT doc_id AS id,
         substring(string_split(text, chr(10))[1], 1, 120) AS title,
         CASE WHEN doc_id % 10 = 0 THEN NULL
              WHEN doc_id % 7 = 0 THEN concat(substring(string_split(text, chr(10))[1], 1, 120), '. ', text)
              ELSE text END AS description,
         CASE WHEN doc_id % 97 = 0 THEN NULL ELSE source END AS source,
         CAST(DATE '2024-01-01' + CAST(doc_id % 180 AS INTEGER) AS DATE) AS pubDate,
         lang AS creators,
         concat('https://example.org/', CAST(doc_id AS VARCHAR)) AS url
  FROM documents)"""

REF_TAGS_SQL = "ref_tags AS " + _values(
    [(r[0], *r[1:]) for r in REF_TAG_ROWS], ["ref_seq", "guid", "tag_cat", "tag", "phrase", "newsroom"]
)
PROFILES_SQL = "profiles AS (SELECT cost_center, CAST(tag_guid AS VARCHAR) AS tag_guid FROM " + _values(
    PROFILE_ROWS, ["cost_center", "tag_guid"]
) + ")"
