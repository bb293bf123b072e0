"""Deal-size expressions: currency detection and amount parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions.text import replace_all, strip

# Currency markers; when several are present the later entry in
# this list wins (a '$' inside 'CDN$' still reads as CDN).
CURRENCY_MARKERS: list[tuple[str, str]] = [
    ("$", "USD"),
    ("€", "EUR"),
    ("CDN$", "CDN"),
    ("AUS$", "AUS"),
    ("£", "GBP"),
    ("¥", "JPY"),
    ("None", "None"),
]
# Literal removals applied in this order before parsing.
AMOUNT_REMOVALS: list[tuple[str, str]] = [
    ("None", "0"),
    ("AUS", ""),
    ("$", ""),
    ("US", ""),
    ("CDN", ""),
    ("€", ""),
    ("£", ""),
    ("¥", ""),
]
UNIT_MILLION = 1_000_000
UNIT_BILLION = 1_000_000_000
VALUE_TYPE = "decimal(20,2)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _filled(deal_size: Column | str) -> Column:
    return F.coalesce(_c(deal_size), F.lit("None"))


def deal_currency(deal_size: Column | str) -> Column:
    """Currency code from the amount text; null when no marker is present."""
    s = _filled(deal_size)
    out = None
    for marker, code in reversed(CURRENCY_MARKERS):  # last match wins → test it first
        out = (F.when if out is None else out.when)(s.contains(marker), F.lit(code))
    return out


def deal_trim(deal_size: Column | str) -> Column:
    return strip(replace_all(_filled(deal_size), AMOUNT_REMOVALS))


def _strip_unit(x: Column, unit: str) -> Column:
    # str.strip(' million') strips any of those characters from both ends
    chars = "".join(sorted(set(" " + unit)))
    return F.regexp_replace(x, f"^[{chars}]+|[{chars}]+$", "")


def deal_value_compat(deal_size: Column | str) -> Column:
    """Exact reference behaviour: any '0' in the trimmed amount gives 0.00."""
    x = deal_trim(deal_size)
    million = _strip_unit(x, "million").try_cast("decimal(38,6)") * F.lit(UNIT_MILLION)
    billion = _strip_unit(x, "billion").try_cast("decimal(38,6)") * F.lit(UNIT_BILLION)
    return (
        F.when(x.contains("0"), F.lit(0).cast(VALUE_TYPE))
        .when(x.contains("million"), million.cast(VALUE_TYPE))
        .when(x.contains("billion"), billion.cast(VALUE_TYPE))
    )


def deal_value(deal_size: Column | str) -> Column:
    """Corrected parse: number × unit; missing amount → 0.00; no unit → null."""
    raw = _c(deal_size)
    x = deal_trim(deal_size)
    num = F.regexp_extract(F.replace(x, F.lit(","), F.lit("")), "([0-9]+(\\.[0-9]+)?)", 1).try_cast("decimal(38,6)")
    return (
        F.when(raw.isNull(), F.lit(0).cast(VALUE_TYPE))
        .when(x.contains("million"), (num * F.lit(UNIT_MILLION)).cast(VALUE_TYPE))
        .when(x.contains("billion"), (num * F.lit(UNIT_BILLION)).cast(VALUE_TYPE))
    )
