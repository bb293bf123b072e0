"""Co-occurrence selector: content carrying a programme's subject tag and an issue tag.

For one programme the profile guids are classified once (a table bounded by
the programme's profile): *subject* = category not Adaptation and not
Current Issues (a null category counts as subject), *issue* = Current Issues.
Content tags are matched to those guids null-safely and reduced per content
with ``bool_or`` – a hash aggregation with map-side combine, so a hot content
id or tag never reaches one task unreduced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.functions import text as X
from newsflow.operators.tags_long import guid_lookup

# Categories that decide the roles of a programme's tags.
EXCLUDED_CATEGORY = "Adaptation"
ISSUE_CATEGORY = "Current Issues"


def classify_programme(profiles: DataFrame, ref_tags: DataFrame, programme: str) -> DataFrame:
    """(tag_guid, in_profile, is_subject, is_issue) for one programme's guids."""
    cats = guid_lookup(ref_tags).select(F.col("guid").alias("_g"), "tag_cat").distinct()
    prog = profiles.where(F.col("cost_center") == F.lit(programme)).select("tag_guid")
    joined = prog.join(cats, prog["tag_guid"].eqNullSafe(cats["_g"]), "left")
    cat = F.col("tag_cat")
    kept = ~cat.eqNullSafe(F.lit(EXCLUDED_CATEGORY))
    return joined.groupBy("tag_guid").agg(
        F.bool_or(kept & ~cat.eqNullSafe(F.lit(ISSUE_CATEGORY))).alias("is_subject"),
        F.bool_or(kept & cat.eqNullSafe(F.lit(ISSUE_CATEGORY))).alias("is_issue"),
    )


def content_flags(content_tags: DataFrame, ref_tags: DataFrame, profiles: DataFrame, programme: str) -> DataFrame:
    """(content_id, has_subject, has_issue) for content touching the programme."""
    g = guid_lookup(ref_tags).select(F.col("tag").alias("_t"), "guid").distinct()
    ct = content_tags.select("content_id", "tag")
    with_guid = ct.join(g, ct["tag"] == g["_t"], "left").select("content_id", "guid")
    k = classify_programme(profiles, ref_tags, programme)
    matched = with_guid.join(k, with_guid["guid"].eqNullSafe(k["tag_guid"]), "inner")
    return matched.groupBy("content_id").agg(
        F.bool_or("is_subject").alias("has_subject"), F.bool_or("is_issue").alias("has_issue")
    )


def cooccurrence_ids(flags: DataFrame) -> DataFrame:
    return flags.where(F.col("has_subject") & F.col("has_issue")).select("content_id")


def subject_ids(flags: DataFrame) -> DataFrame:
    return flags.where(F.col("has_subject")).select("content_id")


REPORT_COLUMNS = ["id", "title", "source", "pubDate", "description", "tag_concat", "url_request"]


def report(content: DataFrame, ids: DataFrame, columns: list[str] | None = None, desc_len: int = 500) -> DataFrame:
    """Content rows for the selected ids with the description shortened to ``desc_len`` + '...'."""
    sel = content.join(ids, content["id"] == ids["content_id"], "left_semi")
    cols = columns or REPORT_COLUMNS
    return sel.select(*[X.truncate_ellipsis("description", desc_len).alias(c) if c == "description" else F.col(c) for c in cols])


def recent_report(content: DataFrame, ids: DataFrame, as_of: str, days: int = 90, min_score: int = 1) -> DataFrame:
    """Scored (> min_score) content of the last ``days`` days restricted to ``ids`` (Q11 fixed)."""
    recent = content.where(
        (F.col("tag_score") > min_score) & (F.col("pubDate") > F.date_sub(F.lit(as_of).cast("date"), days))
    )
    return report(recent, ids, REPORT_COLUMNS + ["tag_score"])
