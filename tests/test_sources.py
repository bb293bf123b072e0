"""File scans: feeds, payloads and CSVs written to a temp folder, then read back."""

import datetime as dt
import json
from decimal import Decimal


from newsflow.operators.cards import card_tags, flatten_cards
from newsflow.operators.deals import new_deals, parse_deals
from newsflow.schemas import REF_TAGS
from newsflow.sources import html as H
from newsflow.sources import readers as R
from newsflow.sources.json_sources import explode_records, guardian_articles, springer_articles
from newsflow.sources.profiles import PROFILES, normalise, rss_items

RSS = """<?xml version="1.0"?>
<rss version="2.0"><channel><title>feed</title>
{items}
</channel></rss>"""
ITEM = "<item><title>{t}</title><link>{l}</link><author>{a}</author><pubDate>{d}</pubDate><description><![CDATA[{s}]]></description></item>"


def test_rss_xml_scan_and_profiles(spark, tmp_path):
    (tmp_path / "eenews.xml").write_text(
        RSS.format(items=ITEM.format(t="Grid", l="u1", a="A", d="Tue, 05 Mar 2024 23:59:00 -0800", s="<p>First</p><p>rest</p>"))
    )
    (tmp_path / "carbonpulse.xml").write_text(
        RSS.format(
            items=ITEM.format(t="Carbon", l="u2", a="B", d="Wed, 06 Mar 2024 01:00:00 +0000", s="<p>S&amp;P Price</p>")
            + ITEM.format(t="Carbon", l="u3", a="C", d="bad date", s="x")
        )
    )
    items = rss_items(R.read_rss(spark, str(tmp_path)))
    assert items.count() == 3
    out = {r.url: r for r in normalise(items, PROFILES["ee_carbonpulse"]).collect()}
    assert out["u1"].source == "E&E News" and out["u1"].description == "First" and out["u1"].pubDate == dt.date(2024, 3, 5)
    assert out["u2"].source == "Carbon Pulse" and out["u2"].description == "Price"
    assert out["u3"].pubDate is None
    lat = normalise(items, PROFILES["la_times"]).collect()
    assert len(lat) == 2  # duplicate title kept once


def test_records_payload(spark, tmp_path):
    recs = [
        {"language": "en", "title": "T1", "creators": [{"creator": "X"}], "publicationName": "J", "doi": "d1",
         "publisher": "Springer", "publicationDate": "2024-01-02", "abstract": "Résumé"},
        {"language": "en", "title": "T2", "creators": [], "publicationName": "J", "doi": "d1",
         "publisher": "Springer", "publicationDate": "2024-01-03", "abstract": "b"},
        {"language": "en", "title": "T3", "creators": None, "publicationName": "J", "doi": None,
         "publisher": "Nature", "publicationDate": "2024-01-04", "abstract": "c"},
    ]
    (tmp_path / "page1.json").write_text(json.dumps({"records": recs}))
    payloads = R.read_records_payloads(spark, str(tmp_path))
    arts = springer_articles(explode_records(payloads, ["_file"]), ["_file", "rec_pos"]).collect()
    by_doi = {r.doi: r for r in arts}
    assert len(arts) == 2 and by_doi["d1"].title == "T1" and by_doi["d1"].description == "Rsum"
    assert by_doi["d1"].url == "http://dx.doi.org/d1" and by_doi[None].url is None


def test_guardian_directory(spark, tmp_path):
    for i in range(2):
        items = [{"webTitle": f"G{i}{j}", "webPublicationDate": "2024-03-05T23:30:00Z", "webUrl": f"w{i}{j}",
                  "fields": {"bodyText": "x" * 600}} for j in range(3)]
        (tmp_path / f"day{i}.json").write_text(json.dumps(items))
    out = guardian_articles(R.read_guardian_items(spark, str(tmp_path))).collect()
    assert len(out) == 6 and all(len(r.description) == 500 and r.pubDate == dt.date(2024, 3, 5) for r in out)


def test_card_pages(spark, tmp_path):
    def cv(title, value=None, text=None):
        return {"column": {"title": title}, "value": value, "text": text}

    item = {"name": "Card A", "column_values": [
        cv("Choose Tags", text="Carbon, Missing"), cv("Status", '"Done"'), cv("Link to page", '{"url":"https://x.org/a?b=1","text":"t"}'),
        cv("Date Published", '{"date":"2024-02-03"}'), cv("Brief Card Description", '"  12 Text here"')]}
    no_url = {"name": "Card B", "column_values": [cv("Status"), cv("Link to page", "{}"), cv("Date Published"), cv("Brief Card Description"), cv("Choose Tags")]}
    page = {"data": {"boards": [{"items_page": {"cursor": None, "items": [item, no_url]}}]}}
    (tmp_path / "p.json").write_text(json.dumps(page))
    cards = flatten_cards(R.read_card_pages(spark, str(tmp_path)), keep=["_file"]).collect()
    assert len(cards) == 1
    c = cards[0]
    assert (c.url, c.pubDate, c.description, c.content_tags) == ("https://x.org/a?b=1", dt.date(2024, 2, 3), "Text here\"", "Carbon, Missing")
    ref = spark.createDataFrame([(1, "g1", "Emissions", "Carbon", "c", "Yes")], REF_TAGS)
    tags = sorted((r.tag, r.tag_guid) for r in card_tags(flatten_cards(R.read_card_pages(spark, str(tmp_path))), ref, []).collect())
    assert tags == [("Carbon", "g1"), ("Missing", None)]


def test_deals_csv(spark, tmp_path):
    header = "Publish Date,Company Name,Investors,Deal Size,Type,Series/Round\n"
    (tmp_path / "AxiosPro_1.csv").write_text(header + '2024-03-05,Acme,"A, B",$5 million,VC,A\n2024-03-05,Beta,C,€10 million,VC,B\n')
    (tmp_path / "AxiosPro_2.csv").write_text(header + "3/6/2024,Gamma,D,,PE,\n")
    (tmp_path / "Other.csv").write_text(header + "2024-03-06,Skip,D,$1 million,PE,\n")
    raw = R.read_deals_csv(spark, str(tmp_path))
    deals = {r.company: r for r in parse_deals(raw).collect()}
    assert set(deals) == {"Acme", "Beta", "Gamma"}
    assert deals["Acme"].deal_currency == "USD" and deals["Acme"].deal_value == Decimal("5000000.00")
    assert deals["Beta"].deal_currency == "EUR" and deals["Gamma"].deal_currency == "None"
    assert deals["Gamma"].pubDate == dt.date(2024, 3, 6)
    assert parse_deals(raw, compat=True).where("company = 'Beta'").first().deal_value == Decimal("0.00")
    existing = parse_deals(raw).where("company <> 'Beta'")
    assert [r.company for r in new_deals(parse_deals(raw), existing).collect()] == ["Beta"]
    assert new_deals(parse_deals(raw), parse_deals(raw)).count() == 0  # loading twice inserts nothing


def test_teasers_zip_within_page(spark):
    html = (
        '<div class="o-teaser__heading"><a href="/a">a</a></div><div class="o-teaser__standfirst">1</div>'
        '<div class="o-teaser__heading">b</div>'
        '<div class="o-teaser--live-blog-package"><div class="o-teaser__heading">live</div></div>'
        '<div class="o-teaser__heading">FT Crossword</div><div class="o-teaser__heading">Letter: x</div>'
    )
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    got = sorted((r.title, r.description) for r in H.teasers(pages, "2024-03-05").collect())
    assert got == [("a", "1"), ("b", None)]


def test_teasers_nested_live_block(spark):
    live = ('<div class="o-teaser o-teaser--live-blog-package"><div class="o-teaser__heading">Live</div>'
            '<div class="o-teaser__standfirst"><div><p>live text</p></div></div><ul><li>x</li></ul></div>')
    html = (
        '<div class="o-teaser__heading js-h"><a href="/a">A &amp; B</a></div>' + live
        + '<div class="o-teaser__standfirst"><div class="inner">one</div> more</div>'
        + '<div class="o-teaser__heading">C</div><div class="o-teaser__standfirst">two</div>'
        + '<div class="o-teaser__heading-link">not a heading</div>'
    )
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    got = sorted((r.title, r.description) for r in H.teasers(pages, "2024-03-05").collect())
    assert got == [("A & B", "one more"), ("C", "two")]


def test_teasers_any_tag_any_depth(spark):
    deep = "<div>" * 9 + "deep" + "</div>" * 9
    live = f'<section class="o-teaser--live-blog-package">{"<div>" * 7}<section><h2 class="o-teaser__heading">Live</h2></section>{"</div>" * 7}</section>'
    html = (
        f'<h2 class="x o-teaser__heading">Solar <em>up</em> 5%<br></h2>{live}behind<p class=\'o-teaser__standfirst\'>one<img src="a"> two</p>'
        f'<div class="o-teaser__heading">{deep}</div><p class="o-teaser__standfirst">never closed <b>at all'
    )
    pages = spark.createDataFrame([(1, "u", html), (2, "u", None), (3, "u", ""), (4, "u", "no tags")], "page_id long, url string, html string")
    got = sorted((r.title, r.description) for r in H.teasers(pages, "2024-03-05").collect())
    assert got == [("Solar up 5%", "one two"), ("deep", "never closed at all")]


def test_result_card_text_is_whole(spark):
    html = '<div class="SoaBEf"><a href="/1"><div class="MBeuO">Solar <em>up</em> 5%</div></a><div class="GI74Re">a<div>b</div>c</div></div>'
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    r = H.result_cards(pages, "2024-03-05 01:00:00").first()
    assert (r.title, r.description, r.source) == ("Solar up 5%", "abc", None)


def test_result_cards(spark):
    card = ('<div class="SoaBEf"><div><a href="https://n.org/{i}"><div class="MBeuO">Title {i}</div>\n'
            '<div class="GI74Re">Snip &amp; more</div><div><span class="LfVVr">{d}</span></div></a>'
            '<div class="NUnG9d"><span>Src</span></div></div></div>')
    html = card.format(i=1, d="2 hours ago") + card.format(i=2, d="LIVE") + card.format(i=1, d="1 day ago")
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    got = sorted((r.title, r.url, r.pubDate, r.description, r.source) for r in H.result_cards(pages, "2024-03-05 01:00:00").collect())
    assert got == [("Title 1", "https://n.org/1", dt.date(2024, 3, 4), "Snip & more", "Src"),
                   ("Title 2", "https://n.org/2", dt.date(2024, 3, 5), "Snip & more", "Src")]


def test_links_relative_only(spark):
    pages = spark.createDataFrame([(1, "u", '<a href="/a">x</a><a class="c" href="https://e.org/b">y</a><a href="/c">z</a>')], "page_id long, url string, html string")
    assert [r.href for r in H.links(pages).orderBy("link_pos").collect()] == ["/a", "/c"]
    assert H.links(pages, relative_only=False).count() == 3


def test_atom_feed_scan(spark, tmp_path):
    atom = """<?xml version="1.0" encoding="utf-8"?>
<feed xmlns="http://www.w3.org/2005/Atom"><title>SSIR</title>
<entry><title>Impact</title><link rel="alternate" href="https://s.org/a"/><link rel="enclosure" href="https://s.org/a.mp3"/>
<author><name>Ann</name></author><updated>2024-03-05T10:00:00Z</updated><summary>Text</summary></entry>
<entry><title>Second</title><link href="https://s.org/b"/><published>2024-03-01T09:00:00Z</published>
<updated>2024-03-04T09:00:00Z</updated><summary>More</summary></entry>
</feed>"""
    (tmp_path / "ssir.xml").write_text(atom)
    items = rss_items(R.read_atom(spark, str(tmp_path)))
    out = {r.title: r for r in normalise(items, PROFILES["ssir"]).collect()}
    assert out["Impact"].url == "https://s.org/a" and out["Impact"].pubDate == dt.date(2024, 3, 5)
    assert out["Second"].url == "https://s.org/b" and out["Second"].pubDate == dt.date(2024, 3, 4)  # SSIR dates by `updated`
    assert out["Impact"].source == "Stanford Social Innovation Review" and out["Impact"].description == "Text"


def test_rss_dc_creator_author(spark, tmp_path):
    feed = ('<?xml version="1.0"?><rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel>'
            '<item><title>T</title><link>u</link><dc:creator>Dana</dc:creator><pubDate>Tue, 05 Mar 2024 10:00:00 GMT</pubDate>'
            '<description>d</description></item></channel></rss>')
    (tmp_path / "lat.xml").write_text(feed)
    out = normalise(rss_items(R.read_rss(spark, str(tmp_path))), PROFILES["la_times"]).first()
    assert out.creators == "Dana"
