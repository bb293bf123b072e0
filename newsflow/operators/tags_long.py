"""Wide tag columns → long, GUID-enriched content tags rolled up to programmes.

Plan shape: the wide table is melted and exploded with generators (no
shuffle, partitioning kept); the GUID and programme lookups are equi-joins
against dimension tables broadcast behind a row-count check; the
(content_id, guid) dedup and the programme roll-up are keyed by content id,
so both reuse one hash partitioning by id (a content id carries a bounded
number of tags, so no key is hot).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.operators.dedup import keep_first
from newsflow.schemas import ALL_CATEGORIES, SCORED_CATEGORIES


def to_long(wide: DataFrame, id_col: str = "id", categories: list[str] | None = None) -> DataFrame:
    """(id, cat columns…) → (content_id, tag_cat, cat_rank, pos, tag); empties dropped.

    ``tag_cat`` is the category the tag was found in, ``cat_rank`` its column
    position and ``pos`` the tag's position in the comma list – together the
    row order of the original melt, used as the "keep first" order downstream.
    The melt is a generator over an array of (category, rank, cell) structs –
    unlike ``unpivot`` (an ``Expand``) it keeps the input's partitioning on the
    id, so later steps keyed by content id need no new shuffle.
    """
    cols = categories or [c for _, c in SCORED_CATEGORIES]
    names = dict((c, n) for n, c in ALL_CATEGORIES)
    cells = F.array(
        *[F.struct(F.lit(names[c]).alias("tag_cat"), F.lit(i).alias("cat_rank"), F.col(c).alias("tags")) for i, c in enumerate(cols)]
    )
    melted = (
        wide.select(F.col(id_col).alias("content_id"), F.inline(cells))
        .where(F.col("tags").isNotNull() & (F.col("tags") != ""))
    )
    exploded = melted.select("content_id", "tag_cat", "cat_rank", F.posexplode(F.split("tags", ",")).alias("pos", "tag"))
    return exploded.where(F.col("tag").isNotNull() & (F.col("tag") != ""))


def guid_lookup(ref_tags: DataFrame) -> DataFrame:
    """Distinct (tag, tag_cat, guid): one row per phrase collapses before the join (Q5)."""
    return ref_tags.select("tag", "tag_cat", "guid").distinct()


def attach_guid(long: DataFrame, ref_tags: DataFrame) -> DataFrame:
    """Left join on tag name (fan-out kept), then keep first per (content_id, guid).

    The category comes from the reference table; unmatched tags keep a null
    guid and all of one content's unmatched tags collapse to one row (Q4).
    """
    ref = guid_lookup(ref_tags).withColumnRenamed("tag", "_rtag").withColumnRenamed("tag_cat", "_rcat")
    joined = long.join(ref, long["tag"] == ref["_rtag"], "left").select(
        "content_id", "tag", F.col("_rcat").alias("tag_cat"), "guid", "pos", "cat_rank"
    )
    first = keep_first(joined, ["content_id", "guid"], ["pos", "cat_rank", "tag", "tag_cat"])
    return first.select("content_id", "tag_cat", "tag", F.col("guid").alias("tag_guid"), "pos", "cat_rank")


def active_profiles(profiles: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Profiles minus excluded programmes; a null programme is kept (pandas ``!=``)."""
    out = profiles
    for name in excluded:
        out = out.where(~F.col("cost_center").eqNullSafe(F.lit(name)))
    return out


def attach_programmes(content_tags: DataFrame, profiles: DataFrame, match_null_keys: bool = True) -> DataFrame:
    """Every matching programme per content tag; unmatched → ``cost_center = ''``.

    The reference's full outer join followed by "content_id not null" is a
    left outer join; with ``match_null_keys`` a null guid matches a profile
    row with a null guid (pandas merge semantics).
    """
    p = profiles.select(F.col("tag_guid").alias("_pguid"), "cost_center")
    cond = content_tags["tag_guid"].eqNullSafe(p["_pguid"]) if match_null_keys else content_tags["tag_guid"] == p["_pguid"]
    joined = content_tags.join(p, cond, "left")
    return joined.select(
        "content_id", "tag_cat", "tag", "tag_guid", F.coalesce(F.col("cost_center"), F.lit("")).alias("cost_center")
    )


def rollup_programmes(with_programmes: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """(content_id, profiles): distinct programmes, sorted, joined by ', ' (Q6, Q7 fixed)."""
    names = F.nullif(F.col("cost_center"), F.lit(""))
    out = with_programmes.groupBy("content_id").agg(
        F.array_join(F.sort_array(F.collect_set(names)), ", ").alias("profiles")
    )
    out = out.where(F.col("profiles") != "")
    return out.where(~F.col("profiles").isin(list(excluded)))


def import_profiles(sheet: DataFrame, ref_tags: DataFrame, order: list[str]) -> DataFrame:
    """Profile sheet (tag, program, …) → (cost_center, tag_guid), one programme per guid.

    The guid join fans out over the reference's phrase rows; keep-first per
    guid (``order`` = sheet order) collapses it, and unresolved tags collapse
    to one null-guid row (Q8).
    """
    ref = ref_tags.select(F.col("tag").alias("_rtag"), "guid")
    joined = sheet.join(ref, sheet["tag"] == ref["_rtag"], "left").select(
        F.col("program").alias("cost_center"), F.col("guid").alias("tag_guid"), *order
    )
    first = keep_first(joined, ["tag_guid"], order + ["cost_center"])
    return first.select("cost_center", "tag_guid")


def tag_transform(
    content: DataFrame,
    existing_content_tags: DataFrame,
    ref_tags: DataFrame,
    profiles: DataFrame,
    excluded: Sequence[str],
    id_col: str = "id",
) -> tuple[DataFrame, DataFrame]:
    """New tagged content → (content tag rows to append, (content_id, profiles) updates)."""
    tagged = content.where(F.col("tag_concat").isNotNull())
    new = tagged.join(
        existing_content_tags.select(F.col("content_id").alias("_cid")),
        tagged[id_col] == F.col("_cid"),
        "left_anti",
    )
    with_guid = attach_guid(to_long(new, id_col), ref_tags)
    rows = attach_programmes(with_guid, active_profiles(profiles, excluded))
    return rows, rollup_programmes(rows, excluded)
