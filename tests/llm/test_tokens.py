import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsflow.llm import token_counts as K
from tests.llm.data import AWKWARD, docs, table


def tree(text, leaf=8):
    encode = K.encoder().encode_ordinary
    leaves = K.cut_leaves(text, leaf)
    return K.SegmentTree(leaves, [len(encode(x)) for x in leaves], encode)


words = st.text(alphabet="ab C1'\n\t_é漢.", max_size=60)


@settings(max_examples=200, deadline=None)
@given(words, st.lists(st.tuples(st.integers(-3, 70), st.integers(0, 30), words), max_size=5))
def test_counts_follow_edits(text, edits):
    t = tree(text)
    for pos, n_del, ins in edits:
        p = max(0, min(pos, len(text)))
        text = text[:p] + ins + text[min(len(text), p + n_del) :]
        t.edit(pos, n_del, ins)
        assert t.text() == text and t.total_tokens == len(K.encoder().encode_ordinary(text))


def test_only_touched_leaves_are_encoded_again():
    text = " ".join(random.Random(1).choice(["alpha", "beta", "gamma"]) for _ in range(20_000))
    t = tree(text, 512)
    t.edit(50_000, 3, "delta")
    assert t.encoded_chars < 2000 and t.total_tokens == len(K.encoder().encode_ordinary(t.text()))


def test_table_against_whole_encoding(spark):
    rows = table(spark, "documents").select("doc_id", "text", K.edit_column("doc_id", "text").alias("edits"))
    got = K.apply_edits(K.build_trees(rows), "edits").collect()
    texts = {r.doc_id: r for r in rows.collect()}
    encode = K.encoder().encode_ordinary
    assert len(got) == len(texts)
    for r in got:
        t = texts[r.doc_id].text
        assert r.n_tokens == len(encode(t))
        for e in texts[r.doc_id].edits:
            t = t[: e.pos] + e.ins + t[e.pos + e.n_del :]
        assert r.edited_text == t and r.edited_tokens == len(encode(t)) == sum(r.edited_leaf_tokens) and sum(r.edited_leaf_chars) == len(t)


def test_awkward_rows(spark):
    rows = docs(spark, AWKWARD)
    edits = F.from_json(F.lit('[null, {"n_del": 1, "ins": "x"}, {"pos": 1000000000, "n_del": 5}]'), f"array<{K.EDIT}>")
    got = K.apply_edits(K.build_trees(rows.withColumn("edits", edits)), "edits").collect()
    assert len(got) == len(AWKWARD) and all(r.edited_tokens == r.n_tokens for r in got)
    assert {r.doc_id: r.n_tokens for r in got}[1] == 0
    nothing = K.apply_edits(K.build_trees(rows.where("false").withColumn("edits", edits)), "edits")
    assert nothing.count() == 0
    none = K.apply_edits(K.build_trees(rows.withColumn("edits", F.lit(None).cast(f"array<{K.EDIT}>"))), "edits")
    assert none.count() == len(AWKWARD)
