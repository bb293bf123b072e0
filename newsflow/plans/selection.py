"""Programme selection as one call: both id lists and both reports (§3.2)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from newsflow.operators.cooccurrence import content_flags, cooccurrence_ids, recent_report, report, subject_ids


@dataclass
class Selection:
    cooccurrence_ids: DataFrame
    subject_ids: DataFrame
    cooccurrence_report: DataFrame
    recent_subject_report: DataFrame


def select_programme(
    content: DataFrame,
    content_tags: DataFrame,
    ref_tags: DataFrame,
    profiles: DataFrame,
    programme: str,
    as_of: str,
    days: int = 90,
) -> Selection:
    """Content carrying a subject and an issue tag of ``programme``, and recent subject content.

    ``content`` needs ``id, title, source, pubDate, description, tag_concat,
    tag_score, url_request``; ``content_tags`` needs ``content_id, tag``.
    """
    flags = content_flags(content_tags, ref_tags, profiles, programme)
    both, subject = cooccurrence_ids(flags), subject_ids(flags)
    return Selection(both, subject, report(content, both), recent_report(content, subject, as_of, days))
