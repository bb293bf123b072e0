"""SQL-text builders for the DuckDB oracle (RE2 regexes, 'g' for global replace)."""

from __future__ import annotations

from newsflow.functions.text import WS_CLASS as WS  # same class text for RE2


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def lstrip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+', '')"


def lstrip_dots(x: str) -> str:
    return f"regexp_replace({x}, '^[.]+', '')"


def clean_description(t: str, d: str) -> str:
    rest = strip(f"substring({d}, length({t}) + 1)")
    return f"(CASE WHEN starts_with({d}, {t}) AND {rest} <> '' THEN {rest} ELSE {d} END)"


def trim_description(t: str, d: str) -> str:
    return lstrip(lstrip_dots(clean_description(t, d)))


def file_title(t: str, n: int = 125) -> str:
    return strip(f"substring(translate({t}, {q(':/<>*\"?|')}, '-'), 1, {n})")


def drop_last_char(x: str) -> str:
    return f"regexp_replace({x}, '.$', '')"


def file_title_retitle(t: str, n: int = 150) -> str:
    removed = f"translate({t}, {q('/<>*\"?|')}, '')"
    return f"substring(translate({drop_last_char(removed)}, ':', '-'), 1, {n})"


def quote_plus(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def in_list(x: str, values: list[str]) -> str:
    return f"{x} IN ({', '.join(q(v) for v in values)})"
