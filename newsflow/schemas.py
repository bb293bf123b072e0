"""Table schemas and the fixed category vocabulary of the article model."""

from __future__ import annotations

from pyspark.sql import types as T

# Tag categories in tag_concat order, with their output column
# names. The first fourteen are scored; Current Issues is tagged but unscored.
SCORED_CATEGORIES: list[tuple[str, str]] = [
    ("Adaptation", "adaptation"),
    ("Behavior", "behavior"),
    ("Emissions", "emissions"),
    ("Environment", "environment"),
    ("Finance", "finance"),
    ("Geography", "geography"),
    ("Industry", "industry"),
    ("Intervention", "intervention"),
    ("Policy", "policy"),
    ("Sector", "sector"),
    ("Technology", "technology"),
    ("Theory of Change", "theory"),
    ("Climate Summits/Conferences", "climate_events"),
    ("Organizational Components", "org_comp"),
]
UNSCORED_CATEGORIES: list[tuple[str, str]] = [("Current Issues", "current_issues")]
ALL_CATEGORIES = SCORED_CATEGORIES + UNSCORED_CATEGORIES
CATEGORY_COLUMNS = [c for _, c in SCORED_CATEGORIES]
ALL_CATEGORY_COLUMNS = [c for _, c in ALL_CATEGORIES]
COLUMN_TO_CATEGORY = {c: n for n, c in ALL_CATEGORIES}

ARTICLE = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("pubDate", T.DateType()),
        T.StructField("url", T.StringType()),
        T.StructField("url_full_txt", T.StringType()),
        T.StructField("creators", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("pubName", T.StringType()),
        T.StructField("doi", T.StringType()),
        T.StructField("journalID", T.StringType()),
    ]
)
ARTICLE_COLUMNS = [f.name for f in ARTICLE.fields]

REF_TAGS = "ref_seq INT, guid STRING, tag_cat STRING, tag STRING, phrase STRING, newsroom STRING"
PROFILES = "cost_center STRING, tag_guid STRING"
CONTENT_TAGS = "content_id BIGINT, tag_cat STRING, tag STRING, tag_guid STRING, cost_center STRING"

RSS_ITEM = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("dc:creator", T.StringType()),
        T.StructField("dc:date", T.StringType()),
        T.StructField("pubDate", T.StringType()),
        T.StructField("updated", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)

ATOM_ENTRY = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField(
            "link",
            T.ArrayType(T.StructType([T.StructField("_href", T.StringType()), T.StructField("_rel", T.StringType())])),
        ),
        T.StructField("author", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("published", T.StringType()),
        T.StructField("updated", T.StringType()),
        T.StructField("summary", T.StringType()),
    ]
)

DEALS_RAW = T.StructType(
    [
        T.StructField("Publish Date", T.StringType()),
        T.StructField("Company Name", T.StringType()),
        T.StructField("Investors", T.StringType()),
        T.StructField("Deal Size", T.StringType()),
        T.StructField("Type", T.StringType()),
        T.StructField("Series/Round", T.StringType()),
    ]
)
DEALS_RENAME = {
    "Publish Date": "pubDate",
    "Company Name": "company",
    "Investors": "investors",
    "Deal Size": "deal_size",
    "Type": "type",
    "Series/Round": "series_round",
}

SPRINGER_PAYLOAD = (
    "records ARRAY<STRUCT<language:STRING,title:STRING,creators:ARRAY<STRUCT<creator:STRING>>,"
    "publicationName:STRING,doi:STRING,publisher:STRING,publicationDate:STRING,abstract:STRING>>"
)
GUARDIAN_ITEM = "webTitle STRING, webPublicationDate STRING, webUrl STRING, fields STRUCT<bodyText:STRING>"
SCOPUS_ITEM = (
    "`dc:title` STRING, `dc:creator` STRING, `prism:publicationName` STRING, `prism:coverDate` STRING, "
    "subtypeDescription STRING, `prism:doi` STRING, openaccessFlag STRING"
)
CROSSREF_ITEM = "title ARRAY<STRING>, URL STRING, abstract STRING, published STRUCT<`date-parts`:ARRAY<ARRAY<INT>>>"
CARD_PAGE = (
    "data STRUCT<boards:ARRAY<STRUCT<items_page:STRUCT<cursor:STRING,items:ARRAY<STRUCT<name:STRING,"
    "column_values:ARRAY<STRUCT<column:STRUCT<title:STRING>,value:STRING,text:STRING>>>>>>>>"
)
