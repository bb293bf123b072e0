"""Unit fixtures of FIXTURES.md §3 for the column expressions."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from newsflow.functions import dates as D
from newsflow.functions import deals as DF
from newsflow.functions import text as X


def one(spark, expr, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def col_values(spark, expr, values, ddl="x string"):
    return [r["r"] for r in spark.createDataFrame([(v,) for v in values], ddl).select(expr.alias("r")).collect()]


def test_clean_description(spark):
    df = spark.createDataFrame([("A b", "A b. More"), ("A b", "A b"), ("A b", "...  x")], "t string, d string")
    got = [r[0] for r in df.select(X.trim_description("t", "d")).collect()]
    assert got == ["More", "A b", "x"]


def test_after_first_separator(spark):
    assert col_values(spark, X.after_first("x", "/></a>"), ["<a><img/></a>body", "plain"]) == ["body", None]


def test_file_title(spark):
    assert one(spark, X.file_title("x"), 'a/b: "c"?') == "ab- c"


def test_quote_plus_matches_python(spark):
    from urllib.parse import quote_plus

    s = "Solar & wind ~50* a+b é"
    assert one(spark, X.quote_plus("x"), s) == quote_plus(s) == "Solar+%26+wind+~50%2A+a%2Bb+%C3%A9"


def test_drop_last_char(spark):
    assert one(spark, X.drop_last_char("x"), "Title.") == "Title"
    assert one(spark, X.drop_last_char("x"), "Title") == "Titl"


def test_currency_order(spark):
    got = col_values(spark, DF.deal_currency("x"), ["CDN$5 million", "AUS$5 million", "US$5 million", None, "5 million", "¥2 billion"])
    assert got == ["CDN", "AUS", "USD", "None", None, "JPY"]


def test_deal_value_compat_and_corrected(spark):
    values = ["$5 million", "$10 million", "$1.5 billion", "$undisclosed", None]
    compat = col_values(spark, DF.deal_value_compat("x"), values)
    fixed = col_values(spark, DF.deal_value("x"), values)
    assert compat == [Decimal("5000000.00"), Decimal("0.00"), Decimal("1500000000.00"), None, Decimal("0.00")]
    assert fixed == [Decimal("5000000.00"), Decimal("10000000.00"), Decimal("1500000000.00"), None, Decimal("0.00")]


def test_feed_date_as_written(spark):
    got = col_values(spark, D.feed_date("x"), ["Tue, 05 Mar 2024 23:59:00 -0800", "garbage", "2024-03-05T23:00:00Z", "TUE, 5 MAR 2024 01:00 GMT"])
    assert got == [dt.date(2024, 3, 5), None, dt.date(2024, 3, 5), dt.date(2024, 3, 5)]


def test_prefix16_date(spark):
    assert one(spark, D.feed_date_prefix("x"), "Tue, 05 Mar 2024 23:59:00 +0000") == dt.date(2024, 3, 5)


def test_relative_date(spark):
    got = col_values(spark, D.relative_date("x", "2024-03-05 01:00:00"),
                     ["2 hours ago", "LIVE", "Mar 1, 2024", "3 days ago", "Yesterday", "today", "1 week ago"])
    assert got == [dt.date(2024, 3, 4), dt.date(2024, 3, 5), dt.date(2024, 3, 1), dt.date(2024, 3, 2),
                   dt.date(2024, 3, 4), dt.date(2024, 3, 5), dt.date(2024, 2, 27)]


def test_date_from_parts(spark):
    df = spark.createDataFrame([([[2023, 8, 24]],), ([[2023, 8]],), ([[2023, 2, 30]],)], "p array<array<int>>")
    assert [r[0] for r in df.select(D.date_from_parts("p")).collect()] == [dt.date(2023, 8, 24), dt.date(2023, 8, 1), None]


def test_day_series(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 30), dt.date(2024, 2, 2))], "a date, b date")
    assert len(df.select(F.explode(D.day_series("a", "b"))).collect()) == 4


def test_title_filters_and_bar(spark):
    from newsflow.sources.profiles import PROFILES, normalise

    rows = [("WATCH | x", "l1", None, "Tue, 05 Mar 2024 10:00:00 +0000", None, "<p>a</p>", "f"),
            ("POLITICS | y", "l2", None, "Tue, 05 Mar 2024 10:00:00 +0000", None, "<p>b</p>", "f"),
            ("z", "l3", None, "Tue, 05 Mar 2024 10:00:00 +0000", None, "c", "f")]
    items = spark.createDataFrame(rows, "title string, link string, author string, published string, updated string, summary string, feed string")
    out = normalise(items, PROFILES["sunday_times"]).orderBy("url").collect()
    assert [r.title for r in out] == ["y", "z"]
    assert [r.description for r in out] == ["b", "c"]


def test_collapse_commas(spark):
    got = col_values(spark, X.collapse_commas("x"), [",,a,,,b,", " , a", "a"])
    assert got == ["a,b", "a", "a"]


def test_small_text_helpers(spark):
    assert one(spark, X.ascii_only("x"), "Résumé – ok") == "Rsum  ok"
    assert col_values(spark, X.piece_after_bar("x"), ["POLITICS | y ", "z", None]) == ["y", "z", None]
    assert one(spark, X.before_first("x", "</p>"), "<p>a</p><p>b</p>") == "<p>a"
    assert col_values(spark, X.truncate_ellipsis("x", 3), ["abcdef", None]) == ["abc...", None]
    assert one(spark, X.strip("x"), "\t a b \n") == "a b"
    assert one(spark, X.lstrip_chars("x", "."), "...a.") == "a."
    assert col_values(spark, X.nullif_empty("x"), ["", "a", None]) == [None, "a", None]
    assert col_values(spark, X.regexp_extract_or_null("x", r"(\d+)"), ["a12", "none"]) == ["12", None]
    assert col_values(spark, X.contains_any("x", ["a", "b"]), ["xbx", "zz", None]) == [True, False, False]


def test_newsroom_flag_null_source(spark):
    assert col_values(spark, X.newsroom_flag("x", ["Rigzone"]), ["Rigzone", "LA Times", None]) == [0, 1, 1]


def test_within_lookback(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 14),), (dt.date(2024, 1, 15),), (dt.date(2024, 1, 20),), (dt.date(2024, 1, 21),)], "d date")
    got = [r[0] for r in df.select(D.within_lookback("d", "2024-01-20", 5)).collect()]
    assert got == [False, True, True, False]


def test_strip_matches_python_unicode_whitespace(spark):
    values = ["   a b 　 ", "\x1c\x85x ", "\t\n\x0b\x0c\r y  ", "no-space"]
    assert col_values(spark, X.strip("x"), values) == [v.strip() for v in values]
    assert col_values(spark, X.lstrip("x"), values) == [v.lstrip() for v in values]


def test_any_date_forms(spark):
    got = col_values(spark, D.any_date("x"), ["3/6/2024", "March 6, 2024", "mar 6, 2024", "2024-03-06", "Wed, 06 Mar 2024 10:00:00 GMT", "soon"])
    assert got == [dt.date(2024, 3, 6)] * 5 + [None]


def test_relative_dates_of_all_units(spark):
    from newsflow.functions.dates import relative_date

    rows = [("30 seconds ago", "2024-03-31"), ("1 month ago", "2024-02-29"), ("2 months ago", "2024-01-31"), ("1 year ago", "2023-03-31"), ("3 weeks ago", "2024-03-10"), ("some day", "None")]
    got = spark.createDataFrame(rows, "rel string, want string").select("want", relative_date("rel", "2024-03-31 12:00:00").cast("string").alias("got")).collect()
    assert all(str(r.got) == r.want for r in got)


def test_long_url_bad_dates_and_blanks(spark):
    from newsflow.functions import text as X
    from newsflow.operators.cards import URL_PATTERN
    from pyspark.sql import functions as F

    url = "https://example.org/" + "a%20b" * 4000
    r = spark.createDataFrame([(url + " end", " \u3000x" + " " * 50_000 + "y\n ")], "u string, s string").select(F.regexp_extract("u", URL_PATTERN, 1).alias("u"), X.strip("s").alias("s"), F.lit("2024-02-31").try_cast("date").alias("d")).first()
    assert r.u == url and r.s == "x" + " " * 50_000 + "y" and r.d is None


def test_thousands_in_deal_sizes(spark):
    from newsflow.functions.deals import deal_value

    rows = [("$1,200 million", 1_200_000_000), ("$1,250.5 million", 1_250_500_000), ("$2 billion", 2_000_000_000)]
    assert all(r.v == r.want for r in spark.createDataFrame(rows, "s string, want long").select("want", deal_value("s").alias("v")).collect())


def test_tagger_without_id_and_with_null_phrase(spark):
    from newsflow.operators.tagging import tag_articles

    arts = spark.createDataFrame([("s", "t1", "solar power up"), ("s", "t1", "solar power up"), ("s", "t2", "ab wind")], "source string, title string, description string")
    for n in (3, 700):
        ref = spark.createDataFrame([(i, "g", "Sector", f"T{i}", f"phrase {i}", "Yes") for i in range(n)] + [(n, "g", "Sector", "Solar", "SOLAR", "Yes"), (n, "g", "Sector", "AB", "ab", "Yes"), (n, "g", "Sector", "Null", None, "Yes")],
                                    "ref_seq int, guid string, tag_cat string, tag string, phrase string, newsroom string")
        assert sorted((r.title, r.tag_concat) for r in tag_articles(arts, ref).collect()) == [("t1", "Solar"), ("t1", "Solar"), ("t2", "AB")]
