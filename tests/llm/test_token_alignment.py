import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsflow.llm import queries
from newsflow.llm import token_alignment as T
from tests.llm.data import AWKWARD, SF, docs, table

NO_TOKENS = (0, 0, 0, 0, "", {})


@pytest.fixture(scope="module")
def aligner():
    return T.Aligner()


def by_hand(aligner, text):
    """Whole texts through the libraries, and cuts by intersecting the sets of ends."""
    if not text:
        return NO_TOKENS
    a_tokens, b_tokens, want = aligner.a.tokenizer, aligner.b.tokenizer, " " + text
    a = a_tokens.tokenizer.encode(want, add_special_tokens=False).ids
    b = b_tokens.tokenizer.encode(text)
    if any(b"".join(t.token[i] for i in ids) != want.encode() for t, ids in ((a_tokens, a), (b_tokens, b))):
        return NO_TOKENS
    end_a, end_b = (np.cumsum([len(t.token[i]) for i in ids]).tolist() for t, ids in ((a_tokens, a), (b_tokens, b)))
    groups, i, j = [], 0, 0
    for cut in sorted(set(end_a) & set(end_b)):
        i2, j2 = end_a.index(cut) + 1, end_b.index(cut) + 1
        groups.append((a[i:i2], b[j:j2]))
        i, j = i2, j2
    links = Counter((x, y) for g, h in groups for x in g for y in h)
    written = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
    return len(a), len(b), len(groups), sum(links.values()), written, dict(links)


def of_batch(found):
    pairs = {(p >> T._ID_BITS, p & ((1 << T._ID_BITS) - 1)): n for p, n in zip(found["pairs"].tolist(), found["times"].tolist(), strict=True)}
    return found["n_a"], found["n_b"], found["n_groups"], found["n_links"], found["groups"], pairs


@pytest.mark.parametrize("lane", [1, 25, T.LANE_CHARS])
def test_batches_against_whole_texts(lane):
    aligner = T.Aligner(lane_chars=lane)
    r = random.Random(lane)
    alphabet = [*" aA1\n\t'’é٣²漢", "ab cd", " the", "the ", "\U0001f389", "<|endoftext|>", "</s>", "antidisestablishment"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(300)]
    texts += ["a" * 4000, "ab " * 2000, "é" * 400, "\U0001f389" * 300, "▁x", "x ▁ y z", "\x00", "ﬁ ½", None, ""]
    for text, found in zip(texts, aligner.align(texts), strict=True):
        assert of_batch(found) == by_hand(aligner, text), text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab C1'\n▁é漢.", max_size=40), max_size=6))
def test_any_texts(texts):
    aligner = T._aligner(None, None, 8)
    assert [of_batch(f) for f in aligner.align(texts)] == [by_hand(aligner, t) for t in texts]


def test_wide_groups_are_counted_by_distinct_ids():
    ids_a, ids_b = np.array([1, 2] * 100), np.array([5] * 60 + [6] * 40)
    who, pair, times = T.group_links(np.array([[0], [200], [0], [100]]), ids_a, ids_b, np.array([3]))
    assert who.tolist() == [3] * 4 and dict(zip(pair.tolist(), times.tolist(), strict=True)) == {1 << 20 | 5: 6000, 1 << 20 | 6: 4000, 2 << 20 | 5: 6000, 2 << 20 | 6: 4000}


def expected(aligner, rows):
    found = [(i, by_hand(aligner, t)) for i, t in rows]
    count = Counter(p for _, f in found for p in f[5])
    most: dict[int, int] = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    return sorted((-1 if i is None else i, *f[:4], hashlib.sha256(f[4].encode()).hexdigest() if f[4] else "", sum(n for p, n in f[5].items() if count[p] == most[p[0]]),
                   sum(n * count[p] for p, n in f[5].items())) for i, f in found)


def rows_of(found):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum) for r in found.collect())


@pytest.mark.parametrize("broadcast", [T.MAX_BROADCAST_PAIRS, 0])
def test_corpus_counts(spark, aligner, broadcast):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").limit(60).collect()]
    rows = rows + rows[:5] + [*AWKWARD, (9, "▁"), (9, "▁")]
    assert rows_of(T.align_corpus(docs(spark, rows), max_broadcast_pairs=broadcast)) == expected(aligner, rows)


def test_table(spark, aligner):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    assert rows_of(queries.op11_token_alignment(spark, SF)) == expected(aligner, rows)


def test_empty_table(spark):
    for n in (0, 10):
        assert T.align_corpus(docs(spark, AWKWARD).where("false"), max_broadcast_pairs=n).count() == 0
