import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsflow.llm import byte_bpe as B
from newsflow.llm import queries
from tests.llm.data import AWKWARD, SF, docs, table


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B._ranks(None), special_tokens={})


def expected(reference, text):
    ids = np.array(reference.encode_ordinary(text or ""), "<u4")
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aA1 \n\t'’srve漢é٣²\x1c\x85　\U0001f389\U000323b0\U00011de0", max_size=50))
def test_ids_are_the_library_s(text):
    import public_tokenizers
    import tiktoken

    whole = tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B._ranks(None), special_tokens={}).encode_ordinary(text)
    encoder = B._encoder(None)
    ids = encoder.encode(B.PreTokenizer(B.class_changes()).split(text))
    assert np.frombuffer(ids, "<u4").tolist() == whole and encoder.decode(ids) == text.encode()


def test_other_classes_than_the_library_s(reference):
    changes = B.class_changes()
    some = random.Random(5).sample(sorted(changes), min(60, len(changes)))
    scan, encoder = B.PreTokenizer(changes), B._encoder(None)
    for c in map(chr, some):
        for text in (c, f"a{c}b", f" {c}{c} 1{c}", f"it's{c}  {c}\n"):
            assert np.frombuffer(encoder.encode(scan.split(text)), "<u4").tolist() == reference.encode_ordinary(text)


def rows_of(found):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found.collect())


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 16), (37, 37), (300, 40), (B.CHUNK, B.OVERLAP)])
def test_chunks_give_what_whole_texts_give(spark, reference, chunk, overlap):
    r = random.Random(chunk)
    alphabet = ["the", " the", "'re", "'", "'ll", " ", "  ", "\n", " \n", "x" * 30, "y" * 90, "12", "漢字", "é", "　", ".", "...", "'s", "re"]
    rows = [(k, "".join(r.choice(alphabet) for _ in range(r.randint(0, 400)))) for k in range(60)]
    rows += [(60, " " * 500), (61, "a" * 700), (62, "'re" * 300), (63, "a b " * 200), (3, rows[3][1]), (3, rows[3][1])]
    want = sorted((i, *expected(reference, t)) for i, t in rows)
    assert rows_of(B.document_digests(docs(spark, rows), chunk=chunk, overlap=overlap)) == want
    if chunk < 300:  # copies of short texts are pieces of one document to a stream of all pieces
        rows = dict(rows).items()
        assert rows_of(B.digests(B.decode(B.encode(docs(spark, rows), chunk=chunk, overlap=overlap)))) == sorted((i, *expected(reference, t)) for i, t in rows)


def test_long_texts_are_dealt_in_pieces(spark):
    rows = [(1, "alpha beta " * 200), (2, "short"), (3, "z" * 3000)]
    n = {r.doc_id: (r["from"], r.n_pieces) for r in B.encode(docs(spark, rows), chunk=256, overlap=64).orderBy("from").collect()}
    assert n[1][1] > 5 and n[2][1] == 1 and n[3][1] == 1  # a word longer than the overlap: one piece


def test_table(spark, reference):
    want = sorted((r.doc_id, *expected(reference, r.text)) for r in table(spark, "documents").collect())
    assert rows_of(queries.op12_byte_bpe(spark, SF)) == want


def test_awkward_rows(spark, reference):
    rows = docs(spark, AWKWARD)
    found = B.document_digests(rows, chunk=1000, overlap=100)
    assert rows_of(found) == sorted((-1 if i is None else i, *expected(reference, t)) for i, t in AWKWARD)
    assert B.document_digests(rows.where("false")).count() == 0
    with pytest.raises(ValueError):
        B.encode_long(rows, chunk=10, overlap=11)
