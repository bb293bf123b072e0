import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from newsflow.operators import phrase_automaton as P
from newsflow.operators import tagging as T
from newsflow.plans import fixtures as fx
from newsflow.plans.q_tagging import many_phrases

CATS = ["A", "B"]
SF = "/root/testdata/sf0.001"


def plain(entries, texts):
    return [{f"c{k}": ",".join(sorted({t for cat, p, t in entries if cat == c and p in x})) or None if x is not None else None for k, c in enumerate(CATS)} for x in texts]


words = st.text(alphabet="abé漢 ", max_size=6)
entries_ = st.lists(st.tuples(st.sampled_from([*CATS, "other"]), words, st.sampled_from("xyz")), max_size=12)


@settings(max_examples=300, deadline=None)
@given(entries_, st.lists(st.one_of(st.none(), st.text(alphabet="abé漢 c", max_size=40)), max_size=6), st.sampled_from([3, 16, P.LANE_BYTES]), st.sampled_from([1, 4000, P.TABLE_BYTES]))
def test_cells_against_contains(entries, texts, lane, table):
    before = P.LANE_BYTES, P.TABLE_BYTES
    P.LANE_BYTES, P.TABLE_BYTES = lane, table  # several lanes a text, several automata
    try:
        assert P.PhraseMatcher(entries, CATS).cells(pa.array(texts, pa.string())).to_pylist() == plain(entries, texts)
    finally:
        P.LANE_BYTES, P.TABLE_BYTES = before


def test_phrases_within_phrases_and_long_texts():
    entries = [("A", "aaaa", "four"), ("A", "aa", "two"), ("B", "a", "one"), ("B", "ba", "ba"), ("B", "", "all")]
    texts = ["a" * 50_000, "b" * 3000 + "a", "", "xbx", None]
    assert P.PhraseMatcher(entries, CATS).cells(pa.array(texts)).to_pylist() == plain(entries, texts)


def test_strategies_agree_on_many_phrases(spark):
    arts, ref = fx.articles(spark, SF), many_phrases(spark, SF)
    assert T._strategy_for(ref, True) == "automaton"
    rows = [sorted(map(str, T.tag_articles(arts, ref, strategy=s).select("id", "sector", "tag_concat", "tag_score").collect())) for s in ("auto", "kgram")]
    assert rows[0] == rows[1] and any("None" not in r for r in rows[0])


def test_dictionaries_beyond_the_bound_are_joined(spark, monkeypatch):
    monkeypatch.setattr(T, "MAX_AUTOMATON_BYTES", 10)
    assert T._strategy_for(many_phrases(spark, SF), True) == "kgram"
    assert T._strategy_for(fx.ref_tags(spark), True) == "inline"


def test_empty_tables(spark):
    ref = fx.ref_tags(spark)
    arts = fx.articles(spark, SF)
    assert T.tag_articles(arts.where("false"), ref, strategy="automaton").count() == 0
    assert T.tag_articles(arts, ref.where("false"), strategy="automaton").where("tag_score IS NOT NULL").count() == 0
