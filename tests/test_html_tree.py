import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from newsflow.sources import html as H
from newsflow.sources import html_tree as T


def plain_elements(pieces, name_class):
    """Every opening tag by itself: the piece at which the tags of its name balance, found by scanning on."""
    out = []
    for k, p in enumerate(pieces):
        m = T._NAME.match(p)
        c = T._CLASS.match(p)
        if not m or p.startswith("</") or m[1].lower() in T.VOID or T._ALONE.match(p) or not c or name_class not in c[1].split():
            continue
        depth, end = 0, len(pieces)
        for j in range(k, len(pieces)):
            n = T._NAME.match(pieces[j])
            if n and n[1].lower() == m[1].lower() and not T._ALONE.match(pieces[j]):
                depth += -1 if pieces[j].startswith("</") else 1
            if depth == 0:
                end = j
                break
        out.append((k, end))
    return out


pages = st.lists(st.sampled_from(["<div>", '<div class="a">', "</div>", '<p class="b a">', "</p>", "<br>", '<p class="c"/>', "t", " < ", '<DIV class=\'c\'>', "</Div>"]), max_size=25).map("".join)


@settings(max_examples=500, deadline=None)
@given(pages)
def test_intervals_against_scanning_on(html):
    pieces = T.split_pieces(html)
    tree = T.element_tree(pieces)
    assert "".join(pieces) == html
    for c in "abc":
        assert [(e.start, e.end) for e in tree if c in e.classes] == plain_elements(pieces, c)
    for e in tree:
        assert e.depth == sum(o.start < e.start < o.end for o in tree)


@settings(max_examples=300, deadline=None)
@given(pages)
def test_left_out_blocks(html):
    pieces = T.split_pieces(html)
    blocks = [e for e in T.element_tree(pieces) if "a" in e.classes]
    want = []
    for k, p in enumerate(pieces):
        if not any(b.start <= k < b.end for b in blocks):
            want.append(T._escaped_rest(p) if any(b.end == k for b in blocks) else p)
    assert T.without(pieces, blocks) == want


def test_ten_thousand_teasers(spark):
    r = random.Random(1)
    body = "".join(f'<div class="o-teaser__heading"><div>t{k}</div></div><p class="o-teaser__standfirst">{"<b>" * r.randint(0, 3)}s{k}</p>' for k in range(10_000))
    page = spark.createDataFrame([(1, f"<html>{body}</html>"), (2, None), (3, "")], "page_id long, html string")
    start = time.time()
    got = H.teasers(page, "2024-03-05").collect()
    assert len(got) == 10_000 and {r.title for r in got} == {f"t{k}" for k in range(10_000)} and time.time() - start < 60
    deep = "<div class='c'>" * 20_000
    assert len(T.class_elements(deep + "x", ["none"])[0]) == 0 and T.element_tree(T.split_pieces(deep))[-1].depth == 19_999
