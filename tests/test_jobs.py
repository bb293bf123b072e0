"""End-to-end jobs on files written to a temp folder."""

import json

from newsflow.plans import jobs
from newsflow.schemas import REF_TAGS

RSS = '<?xml version="1.0"?><rss version="2.0"><channel>{items}</channel></rss>'
ITEM = "<item><title>{t}</title><link>{l}</link><pubDate>Tue, 05 Mar 2024 10:00:00 +0000</pubDate><description><![CDATA[<p>{d}</p>]]></description></item>"


def test_extract_feeds(spark, tmp_path):
    (tmp_path / "lat").mkdir()
    (tmp_path / "lat" / "lat.xml").write_text(RSS.format(items=ITEM.format(t="A", l="u1", d="x") + ITEM.format(t="A", l="u2", d="y")))
    (tmp_path / "wsj").mkdir()
    (tmp_path / "wsj" / "wsj.xml").write_text(RSS.format(items=ITEM.format(t="B", l="u3", d="z")))
    out = jobs.extract_feeds(spark, {"la_times": str(tmp_path / "lat"), "wsj": str(tmp_path / "wsj")}, str(tmp_path / "extract"))
    got = sorted((r.source, r.title, r.description, r.creators) for r in out.collect())
    assert got == [("LA Times", "A", "x", None), ("Wall St. Journal", "B", "<p>z</p>", "")]


def test_extract_feeds_atom_and_payloads(spark, tmp_path):
    (tmp_path / "wsj").mkdir()
    (tmp_path / "wsj" / "a.xml").write_text('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>T</title><link href="u"/><updated>2024-03-05T00:00:00Z</updated></entry></feed>')
    (tmp_path / "records").mkdir()
    (tmp_path / "records" / "p.json").write_text(json.dumps({"records": [{"title": "R", "doi": "d1", "publisher": "P", "publicationDate": "2024-01-02"}, {"title": "S", "doi": "d1", "publisher": "P"}]}))
    (tmp_path / "guardian").mkdir()
    (tmp_path / "guardian" / "g.json").write_text(json.dumps([{"webTitle": "G", "webUrl": "w", "webPublicationDate": "2024-01-03T00:00:00Z", "fields": {"bodyText": "b"}}]))
    (tmp_path / "scopus").mkdir()
    (tmp_path / "scopus" / "s.json").write_text(json.dumps([{"prism:doi": "d", "dc:title": "E", "prism:coverDate": d} for d in ("2024-01-04", "2024-01-05")]))
    landed = {f: str(tmp_path / f) for f in ("wsj", "records", "guardian", "scopus")}
    out = jobs.extract_feeds(spark, landed, str(tmp_path / "extract"), before="2024-02-01")
    got = sorted((r.title, str(r.pubDate)) for r in out.collect())
    assert got == [("E", "2024-01-04"), ("G", "2024-01-03"), ("R", "2024-01-02"), ("T", "2024-03-05")]


def test_load_deals_twice(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    header = "Publish Date,Company Name,Investors,Deal Size,Type,Series/Round\n"
    (tmp_path / "csv" / "AxiosPro_a.csv").write_text(header + "2024-03-05,Acme,I,$5 million,VC,A\n2024-03-05,Beta,I,,VC,B\n")
    assert jobs.load_deals(spark, str(tmp_path / "csv"), str(tmp_path / "deals")) == 2
    assert jobs.load_deals(spark, str(tmp_path / "csv"), str(tmp_path / "deals")) == 0  # idempotent
    assert spark.read.parquet(str(tmp_path / "deals")).count() == 2


def test_refresh_cards(spark, tmp_path):
    def cv(title, value=None, text=None):
        return {"column": {"title": title}, "value": value, "text": text}

    item = {"name": "Card", "column_values": [cv("Status", '"x"'), cv("Link to page", '{"url":"https://c.org/1"}'),
                                              cv("Date Published", '{"date":"2024-01-02"}'), cv("Brief Card Description", '"Text"'),
                                              cv("Choose Tags", text="Carbon")]}
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "p1.json").write_text(json.dumps({"data": {"boards": [{"items_page": {"items": [item]}}]}}))
    ref = spark.createDataFrame([(1, "g1", "Emissions", "Carbon", "c", "Yes")], REF_TAGS)
    for _ in range(2):  # replaced, not appended
        jobs.refresh_cards(spark, str(tmp_path / "pages"), ref, str(tmp_path / "cards"), str(tmp_path / "card_tags"))
    assert spark.read.parquet(str(tmp_path / "cards")).count() == 1
    assert [(r.title, r.tag, r.tag_guid) for r in spark.read.parquet(str(tmp_path / "card_tags")).collect()] == [("Card", "Carbon", "g1")]


def test_research_job_matches_queries(spark, tmp_path):
    import __spark_entry__ as E
    from pyspark.sql import functions as F

    from newsflow.operators.tagging import tag_articles
    from newsflow.operators.tags_long import to_long
    from newsflow.plans import fixtures as fx
    from newsflow.plans import q_select as Q
    from newsflow.schemas import ALL_CATEGORY_COLUMNS

    sf = "/root/testdata/sf0.001"
    Q._content(spark, sf).write.parquet(str(tmp_path / "content"))
    tagged = tag_articles(fx.articles(spark, sf), fx.ref_tags(spark)).where(
        F.col("tag_concat").isNotNull() | F.col("current_issues").isNotNull()
    )
    to_long(tagged, categories=ALL_CATEGORY_COLUMNS).write.parquet(str(tmp_path / "tags"))
    sel = jobs.research(spark, str(tmp_path / "content"), str(tmp_path / "tags"), fx.ref_tags(spark), fx.profiles(spark),
                        Q.PROGRAMME, "2024-07-01", out_path=str(tmp_path / "reports"))
    q = E.queries()
    assert sorted(map(tuple, sel.recent_subject_report.collect())) == sorted(map(tuple, q["recent_subject_report"](spark, sf).collect()))
    assert spark.read.parquet(str(tmp_path / "reports" / "cooccurrence")).count() == q["cooccurrence_report"](spark, sf).count()
