"""Date expressions: feed dates as written (no zone shift), relative dates, series."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

RFC822_DAY = "(\\d{1,2} [A-Za-z]{3} \\d{4})"
ISO_DAY = "(\\d{4}-\\d{2}-\\d{2})"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def feed_date(col: Column | str) -> Column:
    """Calendar date as written in an RSS/ISO date string; null when unparseable.

    ``Tue, 05 Mar 2024 23:59:00 -0800`` → 2024-03-05 (the zone is ignored on
    purpose: the feed's own day is kept). ISO strings take their date part.
    """
    c = _c(col)
    # month names parse case-sensitively in Java: normalise "MAR"/"mar" to "Mar"
    rfc = F.try_to_timestamp(F.initcap(F.lower(F.regexp_extract(c, RFC822_DAY, 1))), F.lit("d MMM yyyy"))
    iso = F.try_to_timestamp(F.regexp_extract(c, ISO_DAY, 1), F.lit("yyyy-MM-dd"))
    return F.coalesce(rfc, iso).cast("date")


def any_date(col: Column | str) -> Column:
    """Feed dates plus the spreadsheet forms (``3/6/2024``, ``March 6, 2024``, ``Mar 6, 2024``)."""
    c = F.trim(_c(col))
    return F.coalesce(
        feed_date(c),
        F.try_to_date(c, "M/d/yyyy"),
        F.try_to_date(F.initcap(F.lower(c)), "MMMM d, yyyy"),
        F.try_to_date(F.initcap(F.lower(c)), "MMM d, yyyy"),
    )


def feed_date_prefix(col: Column | str, n: int = 16) -> Column:
    """Date from the first ``n`` characters only (Washington-Post style feeds)."""
    return feed_date(F.substring(_c(col), 1, n))


def relative_date(col: Column | str, as_of: _dt.datetime | str) -> Column:
    """``"2 hours ago"`` / ``LIVE`` / ``today`` / ``yesterday`` / a free-form date → date, relative to ``as_of``.

    Arithmetic is on ``timestamp_ntz`` (wall-clock), so the session time zone
    and its daylight-saving changes cannot move the result.
    """
    c = _c(col)
    ts = F.lit(as_of).cast("timestamp_ntz")
    pat = "^(\\d+) (second|minute|hour|day|week|month|year)s? ago$"
    n = F.regexp_extract(c, pat, 1).cast("int")
    unit = F.regexp_extract(c, pat, 2)
    secs = F.when(unit == "second", n).when(unit == "minute", n * 60).when(unit == "hour", n * 3600).when(unit == "day", n * 86400).when(
        unit == "week", n * 604800
    )
    months = F.when(unit == "month", n).when(unit == "year", n * 12)
    rel = F.coalesce(F.timestamp_add("MONTH", -months, ts), F.timestamp_add("SECOND", -secs, ts))
    free = F.coalesce(
        F.try_to_timestamp(c, F.lit("MMM d, yyyy")),
        F.try_to_timestamp(c, F.lit("d MMM yyyy")),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd")),
    )
    word = F.lower(F.trim(c))
    return (
        F.when(F.upper(c) == "LIVE", ts.cast("date"))
        .when(word == "today", ts.cast("date"))
        .when(word == "yesterday", F.date_sub(ts.cast("date"), 1))
        .when(c.rlike(pat), rel.cast("date"))
        .otherwise(free.cast("date"))
    )


def strip_zone(col: Column | str) -> Column:
    return _c(col).cast("timestamp_ntz")


def day_series(start: Column | str, end: Column | str) -> Column:
    """One element per day from ``start`` to ``end`` inclusive (explode it)."""
    return F.sequence(_c(start).cast("date"), _c(end).cast("date"), F.expr("interval 1 day"))


def date_from_parts(parts: Column | str) -> Column:
    """CrossRef ``date-parts`` ``[[y, m, d]]`` → date; missing month/day → 1; invalid → null."""
    p = F.get(_c(parts), 0)
    text = F.concat_ws("-", F.get(p, 0), F.coalesce(F.get(p, 1), F.lit(1)), F.coalesce(F.get(p, 2), F.lit(1)))
    return F.try_to_date(text, "y-M-d")


def within_lookback(col: Column | str, as_of: str, days: int) -> Column:
    """``as_of - days <= col <= as_of`` on dates: the look-back window of a daily poll."""
    d = _c(col).cast("date")
    end = F.lit(as_of).cast("date")
    return (d >= F.date_sub(end, days)) & (d <= end)
