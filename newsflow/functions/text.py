"""Text column expressions used by cleaning, loading and source normalisers.

All functions take and return ``Column`` objects so Catalyst can fold them
into whole-stage codegen; none of them executes Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() whitespace (str.isspace), in \x{...} form that Java
# regex and RE2 both read.
WS_RANGES = "\\x{09}-\\x{0D}\\x{1C}-\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
WS_CLASS = f"[{WS_RANGES}]"
WS_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Characters removed from file titles, and the colon replacement.
FILE_TITLE_REMOVED = '/<>*"?|'
FILE_TITLE_COLON = ":"
FILE_TITLE_COLON_TO = "-"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Strip leading and trailing whitespace (Spark ``trim`` only strips blanks)."""
    return F.btrim(_c(col), F.lit(WS_CHARS))


def lstrip(col: Column | str) -> Column:
    return F.ltrim(_c(col), F.lit(WS_CHARS))


def lstrip_chars(col: Column | str, chars: str) -> Column:
    """``str.lstrip(chars)`` for a set of literal characters."""
    klass = "".join("\\" + ch if not ch.isalnum() else ch for ch in chars)
    return F.regexp_replace(_c(col), f"^[{klass}]+", "")


def nullif_empty(col: Column | str) -> Column:
    c = _c(col)
    return F.when(c != F.lit(""), c)


def truncate(col: Column | str, n: int) -> Column:
    """First ``n`` characters (code points), null stays null."""
    return F.substring(_c(col), 1, n)


def truncate_ellipsis(col: Column | str, n: int = 500) -> Column:
    """``text[:n] + '...'`` – the ellipsis is always appended; null stays null."""
    return F.concat(F.substring(_c(col), 1, n), F.lit("..."))


def clean_description(title: Column | str, description: Column | str) -> Column:
    """Drop a leading copy of the title from the description when text remains."""
    t, d = _c(title), _c(description)
    rest = strip(F.substring(d, F.length(t) + 1, F.lit(2147483647)))
    return F.when(d.startswith(t) & (rest != F.lit("")), rest).otherwise(d)


def trim_description(title: Column | str, description: Column | str) -> Column:
    """clean_description, then strip leading dots, then leading whitespace."""
    return lstrip(lstrip_chars(clean_description(title, description), "."))


def file_title(title: Column | str, max_len: int = 125) -> Column:
    """Remove characters that break file names, ':' → '-', cut, strip."""
    cleaned = F.translate(_c(title), FILE_TITLE_COLON + FILE_TITLE_REMOVED, FILE_TITLE_COLON_TO)
    return strip(F.substring(cleaned, 1, max_len))


def drop_last_char(col: Column | str) -> Column:
    """The ``.$`` regex replacement: removes whatever character is last."""
    return F.regexp_replace(_c(col), ".$", "")


def quote_plus(col: Column | str) -> Column:
    """Python ``urllib.parse.quote_plus`` on top of Java's URL encoder.

    Java keeps ``*`` and encodes ``~``; Python does the opposite.
    """
    enc = F.url_encode(_c(col))
    return F.replace(F.replace(enc, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def request_url(prefix: str, file_title_col: Column | str, encode: bool = True) -> Column:
    c = _c(file_title_col)
    return F.concat(F.lit(prefix), quote_plus(c) if encode else c)


def ascii_only(col: Column | str) -> Column:
    return F.regexp_replace(_c(col), "[^\\x00-\\x7F]", "")


def before_first(col: Column | str, sep: str) -> Column:
    """Text before the first ``sep`` (whole text when absent)."""
    return F.substring_index(_c(col), sep, 1)


def after_first(col: Column | str, sep: str) -> Column:
    """Second piece of a split on ``sep``; null when ``sep`` is absent."""
    return F.get(F.split(_c(col), _regex_literal(sep)), 1)


def piece_after_bar(col: Column | str) -> Column:
    """Second ``|``-separated piece when a bar is present, stripped."""
    c = _c(col)
    return strip(F.when(c.contains("|"), F.get(F.split(c, "[|]"), 1)).otherwise(c))


def _regex_literal(s: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in s)


def replace_all(col: Column | str, pairs: list[tuple[str, str]]) -> Column:
    """Literal (non-regex) replacements applied in order."""
    out = _c(col)
    for a, b in pairs:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def collapse_commas(col: Column | str) -> Column:
    """``,{2,}`` → ``,`` then strip leading/trailing commas and whitespace."""
    c = F.regexp_replace(_c(col), ",{2,}", ",")
    return F.regexp_replace(c, f"^[,{WS_RANGES}]+|[,{WS_RANGES}]+$", "")


def newsroom_flag(source: Column | str, excluded: list[str]) -> Column:
    """0 for sources outside the newsroom, else 1 (null source counts as newsroom)."""
    s = _c(source)
    return F.when(s.isin(excluded), F.lit(0)).otherwise(F.lit(1))


def contains_any(col: Column | str, markers: list[str]) -> Column:
    c = _c(col)
    out = F.lit(False)
    for m in markers:
        out = out | F.coalesce(c.contains(m), F.lit(False))
    return out


def matches_keywords(columns: list[Column | str], keywords: list[str]) -> Column:
    """Whether any column holds any keyword, case-insensitively: a search API's keyword predicate on landed rows."""
    out = F.lit(False)
    for c in columns:
        out = out | contains_any(F.lower(_c(c)), [k.lower() for k in keywords])
    return out


def regexp_extract_or_null(col: Column | str, pattern: str, idx: int = 1) -> Column:
    """pandas ``str.extract`` semantics: null when there is no match."""
    c = _c(col)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, idx))


def file_title_retitle(title: Column | str, max_len: int = 150) -> Column:
    """Title-update variant: remove characters, drop the last character, ':' → '-', cut (no strip)."""
    removed = F.translate(_c(title), FILE_TITLE_REMOVED, "")
    return F.substring(F.translate(drop_last_char(removed), FILE_TITLE_COLON, FILE_TITLE_COLON_TO), 1, max_len)
